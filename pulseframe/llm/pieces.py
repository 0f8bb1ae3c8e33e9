"""SentencePiece BPE with byte fallback: encoding by vectorised merge rounds, decoding by tables.

Texts are cut where no piece of the model can reach across: before a space that follows another character, around characters
that no piece holds, and between two characters that no piece has next to each other. Each distinct word of a group of texts
is encoded once. All its words lie in flat numpy arrays of symbols. A round finds every word's pair of least rank, merges all
its places from the left at once, closes the gaps and looks up the pairs that are new; a word without a pair is finished.

A library merges one place at a time, the best first. Merging all places of a piece at once gives the same unless the merged
piece could at once go into another one of the same or a better rank: of such pieces, which are told by the model, a round
merges the leftmost place of a word only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .words import groups

#: Bytes of text whose words are told apart together; words whose ids are joined at once in a text beyond all bounds.
GROUP_BYTES, JOINED = 8 << 20, 4_000_000
SPACE = "▁"
#: Symbols from here on are characters without a piece of their own.
ALONE = 1 << 24
NEVER = np.iinfo(np.int32).max


def model_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class _Table:
    """int64 keys to int32 values, looked up many at a time: open addressing."""

    def __init__(self, entries: dict[int, int]):
        bits = max(8, (4 * len(entries)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.values = np.full(1 << bits, -1, np.int64), np.full(1 << bits, -1, np.int32)
        keys, values = np.fromiter(entries.keys(), np.int64, len(entries)), np.fromiter(entries.values(), np.int32, len(entries))
        at = self._slot(keys)
        while len(keys):
            free = self.keys[at] == -1
            first = np.zeros(len(keys), bool)
            first[np.unique(at, return_index=True)[1]] = True
            put = free & first
            self.keys[at[put]], self.values[at[put]] = keys[put], values[put]
            keys, values, at = keys[~put], values[~put], (at[~put] + ~free[~put]) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def get(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The value of each pair; -1 without one."""
        keys = (left.astype(np.int64) << 32) | right
        at = self._slot(keys)
        held = self.keys[at]
        out = np.where(held == keys, self.values[at], np.int32(-1))
        rest = np.nonzero((held != keys) & (held != -1))[0]
        while len(rest):
            at[rest] = (at[rest] + 1) & self.mask
            held = self.keys[at[rest]]
            met = held == keys[rest]
            out[rest[met]] = self.values[at[rest[met]]]
            rest = rest[~met & (held != -1)]
        return out


class Model:
    """The tables of a model file: BPE, byte fallback, no normalisation, a space in front of every text."""

    def __init__(self, path: str):
        import sentencepiece

        lib = sentencepiece.SentencePieceProcessor(model_file=path)
        n = lib.vocab_size()
        names, self.byte = [lib.id_to_piece(i) for i in range(n)], np.full(256, -1, np.int32)
        for i in range(n):
            if lib.is_byte(i):
                self.byte[int(names[i][3:5], 16)] = i
        own = [i for i in range(n) if not (lib.is_byte(i) or lib.is_control(i) or lib.is_unknown(i) or lib.is_unused(i))]
        if (self.byte < 0).any() or lib.encode("Ａ", out_type=str)[0] != SPACE or lib.decode(lib.encode(" Ａ ")) != " Ａ ":
            raise ValueError("the model must have byte fallback, a space before the text and no normalisation")
        number, scores = {names[i]: i for i in own}, sorted({-lib.get_score(i) for i in own})
        place = {s: r for r, s in enumerate(scores)}
        self.rank = np.full(n, NEVER, np.int32)
        for i in own:
            self.rank[i] = place[-lib.get_score(i)]
        symbol = lambda x: number.get(x, ALONE + ord(x) if len(x) == 1 else None)
        pairs, near, chars, alone = {}, {}, {c for i in own for c in names[i]}, set()
        shares = np.bincount(self.rank[own], minlength=len(scores))
        for i in own:
            x = names[i]
            if shares[self.rank[i]] > 1:
                alone.add(i)
            for k in range(1, len(x)):
                a, b = symbol(x[:k]), symbol(x[k:])
                near[ord(x[k - 1]) << 32 | ord(x[k])] = 1
                if a is not None and b is not None:
                    pairs[a << 32 | b] = i
                alone |= {p for p in (a, b) if p is not None and p < ALONE and self.rank[i] <= self.rank[p]}
        self.pairs, self.near = _Table(pairs), _Table(near)
        #: Pieces of which a round merges one place of a word only.
        self.one = np.zeros(n, bool)
        self.one[list(alone)] = True
        self.symbol = np.arange(ALONE, ALONE + 0x110000, dtype=np.int32)
        for c in chars & number.keys():
            self.symbol[ord(c)] = number[c]
        self.symbol[32] = self.symbol[ord(SPACE)]
        if any(SPACE in x.lstrip(SPACE) for x in number):
            raise ValueError("a piece goes on after a space")
        #: ASCII characters that no piece holds.
        self.apart = np.array([chr(c) not in chars and c != 32 for c in range(128)] + [False] * 128)
        #: A run of spaces is cut into runs so long, if the model's own order does the same: no other piece holds two spaces,
        #: pieces of spaces only are merged last, and a longer run gives the longest piece and then what the rest gives.
        runs, self.run = {len(x): i for x, i in number.items() if x == SPACE * len(x)}, 0
        longest = max(runs, default=1)
        if longest > 1 and set(self.rank[list(runs.values())].tolist()) == {len(scores) - 1} and shares[-1] == len(runs) and not any(SPACE * 2 in x and x != SPACE * len(x) for x in number):
            alike = [self.merged(np.full(r, runs[1], np.int32), np.zeros(r, np.int64))[0].tolist() for r in range(1, 3 * longest)]
            if all(alike[r - 1] == [runs[longest], *alike[r - longest - 1]] for r in range(longest + 1, 3 * longest)):
                self.run = longest
        texts = [x.replace(SPACE, " ").encode() for x in names]
        for i in range(n):
            texts[i] = b"" if lib.is_control(i) else bytes([int(names[i][3:5], 16)]) if lib.is_byte(i) else texts[i]
        self.decimal, self.text = pa.array([str(i).encode() for i in range(n)], pa.binary()), pa.array(texts, pa.binary())

    def merged(self, sym: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols of all words after the last round, and each one's word. word ascends."""
        done: list[tuple[np.ndarray, np.ndarray]] = []
        piece = np.full(len(sym), -1, np.int32)
        inside = np.nonzero(word[1:] == word[:-1])[0]
        piece[inside] = self.pairs.get(sym[inside], sym[inside + 1])
        rank = np.where(piece >= 0, self.rank[piece], NEVER)
        while len(sym):
            first = np.nonzero(np.diff(word, prepend=-1))[0]
            size = np.diff(first, append=len(word))
            best = np.minimum.reduceat(rank, first)
            if (over := best == NEVER).any():
                gone = np.repeat(over, size)
                done.append((word[gone], sym[gone]))
                sym, word, piece, rank = sym[~gone], word[~gone], piece[~gone], rank[~gone]
                best, size = best[~over], size[~over]
                if not len(sym):
                    break
            hit = np.nonzero(rank == np.repeat(best, size))[0]
            # of places that overlap every other one counts; of some pieces the first place of each word
            start = np.diff(hit, prepend=-2) != 1
            nth = np.arange(len(hit)) - np.maximum.accumulate(np.where(start, np.arange(len(hit)), 0))
            hit_word = word[hit]
            take = np.where(self.one[piece[hit]], np.diff(hit_word, prepend=-1) != 0, nth % 2 == 0)
            hit = hit[take]
            sym[hit] = piece[hit]
            kept = np.ones(len(sym), bool)
            kept[hit + 1] = False
            # where the merged symbols stand afterwards, and the places before them
            new = hit - np.arange(len(hit))
            sym, word, piece, rank = sym[kept], word[kept], piece[kept], rank[kept]
            fresh = np.zeros(len(sym), bool)
            fresh[new] = fresh[np.maximum(new - 1, 0)] = True
            at = np.nonzero(fresh)[0]
            piece[at], rank[at] = -1, NEVER
            at = at[at + 1 < len(sym)]
            at = at[word[at] == word[at + 1]]
            found = self.pairs.get(sym[at], sym[at + 1])
            piece[at] = found
            rank[at] = np.where(found >= 0, self.rank[found], NEVER)
        if not done:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        words, syms = np.concatenate([x[0] for x in done]), np.concatenate([x[1] for x in done])
        order = np.argsort(words, kind="stable")
        return syms[order], words[order]

    def encode_words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of distinct words one after the other, and how many each has."""
        if not len(words):
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        offsets = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
        flat = np.frombuffer(words.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
        chars = np.frombuffer(flat.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32).astype(np.int64)
        upto = np.concatenate([[0], np.cumsum((flat & 0xC0) != 0x80)])[offsets - offsets[0]]
        n_chars = np.diff(upto)
        word = np.repeat(np.arange(len(words)), n_chars)
        chars[chars == 32] = ord(SPACE)
        # characters that no piece has next to each other are words apart
        cut = np.ones(len(chars), bool)
        cut[1:] = (word[1:] != word[:-1]) | (self.near.get(chars[:-1], chars[1:]) < 0)
        sym, part = self.merged(self.symbol[chars], np.cumsum(cut) - 1)
        word = word[np.nonzero(cut)[0]][part] if len(part) else part
        # what has no piece falls back to bytes
        lone = np.nonzero(sym >= ALONE)[0]
        if len(lone):
            codes, which = np.unique(sym[lone] - ALONE, return_inverse=True)
            spelt = [self.byte[np.frombuffer(chr(c).encode(), np.uint8)] for c in codes.tolist()]
            times = np.ones(len(sym), np.int64)
            times[lone] = np.array([len(s) for s in spelt])[which]
            at = np.cumsum(times) - times
            sym, word = np.repeat(sym, times), np.repeat(word, times)
            for k in range(4):
                some = np.nonzero(times[lone] > k)[0]
                sym[at[lone[some]] + k] = [spelt[w][k] for w in which[some].tolist()]
        return sym, np.bincount(word, minlength=len(words))

    def words(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """(distinct words, for each word its number among them, words of each text)."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        if pc.any(pc.match_substring(texts, SPACE)).as_py():
            texts = pc.replace_substring(texts, SPACE, " ")  # the two become one symbol
        texts = pc.if_else(pc.equal(pc.binary_length(texts), 0), "", pc.binary_join_element_wise(" ", texts, "")).cast(pa.large_binary())
        ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        flat = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
        ends = ends - ends[0]
        if not len(flat):
            return pa.array([], pa.binary()), np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
        space, apart = flat == 32, self.apart[flat]
        cut = apart.copy()
        cut[1:] |= apart[:-1] | (space[1:] & ~space[:-1])
        cut[ends[:-1][ends[:-1] < len(flat)]] = True
        if self.run and (space[1:] & space[:-1]).sum() >= self.run:
            # every so many spaces of a run, as long as one is left behind the cut
            at = np.arange(len(flat))
            since = at - np.maximum.accumulate(np.where(cut | ~space, at, 0))
            cut |= space & (since > 0) & (since % self.run == 0)
        first = np.nonzero(cut)[0]
        bounds = pa.py_buffer(np.append(first, len(flat)).astype(np.int64))
        found = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(first), [None, bounds, pa.py_buffer(flat)]).dictionary_encode()
        return found.dictionary.cast(pa.binary()), found.indices.to_numpy().astype(np.int64), np.diff(np.searchsorted(first, ends))


@lru_cache(maxsize=2)
def load(path: str) -> Model:
    return Model(path)


def _joined(items: pa.Array, n: np.ndarray, by: bytes) -> pa.Array:
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32)), items), by)


def _digests(each: pa.Array, number: np.ndarray, n: np.ndarray, by: bytes, skip: int) -> list[str]:
    """Of each text the SHA-256 of its words' strings, joined, without the first `skip` bytes."""
    if len(number) <= JOINED:
        held = _joined(each.take(pa.array(number)), n, by)
        ends, data = np.frombuffer(held.buffers()[1], np.int32)[: len(n) + 1].tolist(), memoryview(held.buffers()[2] or b"")
        return [hashlib.sha256(data[min(a + skip, b) : b]).hexdigest() for a, b in zip(ends[:-1], ends[1:], strict=True)]
    out, at = [], 0
    for size in n.tolist():
        h = hashlib.sha256()
        for k in range(at, at + size, JOINED):
            part = _joined(each.take(pa.array(number[k : min(k + JOINED, at + size)])), np.array([min(JOINED, at + size - k)]), by)[0].as_py()
            h.update(part[skip:] if k == at else by + part)
        out.append(h.hexdigest())
        at += size
    return out


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str | None = None) -> DataFrame:
    """(id_col, ids array<int>): a row for each row of docs, in its place, without begin or end ids.

    Null and empty texts have no ids. Repeated rows and null ids stay; texts are encoded whole; an empty table gives no rows;
    other columns are not looked at."""
    path = model or model_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = load(path)
        for batch in batches:
            for b in groups(batch, 1, GROUP_BYTES):
                words, number, n = m.words(b.column(1))
                ids, per_word = m.encode_words(words)
                first = np.cumsum(per_word) - per_word
                times = per_word[number]
                spot = np.repeat(first[number] - (np.cumsum(times) - times), times) + np.arange(int(times.sum()))
                upto = np.concatenate([[0], np.cumsum(times)])[np.concatenate([[0], np.cumsum(n)])]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(pa.array(upto.astype(np.int32)), pa.array(ids[spot], pa.int32()))], ["id", "ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, ids array<int>").select(F.col("id").alias(id_col), "ids")


def decode(rows: DataFrame, ids_col: str = "ids", out: str = "text", model: str | None = None) -> DataFrame:
    """rows with `out`, the text of the ids in ids_col (array<int>): pieces one after the other, bytes for the pieces of the
    byte fallback, without the space in front; a byte that is no UTF-8 becomes the replacement character. Null ids have a
    null text. A null or an unknown id in the list is an error."""
    path, at = model or model_path(), rows.columns.index(ids_col)
    if out in rows.columns:
        raise ValueError(f"{out} is there already")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = load(path)
        for b in batches:
            held = b.column(at)
            n = pc.fill_null(pc.list_value_length(held), 0).to_numpy(zero_copy_only=False)
            parts = _joined(m.text.take(held.flatten()), n, b"").to_pylist()
            texts = [None if null else x.removeprefix(b" ").decode("utf-8", "replace") for x, null in zip(parts, pc.is_null(held).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], [*b.schema.names, out])

    return rows.mapInArrow(run, StructType([*rows.schema.fields, StructField(out, StringType())]))


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str | None = None) -> DataFrame:
    """(id_col, n_tokens, ids_sha256, decoded_sha256): as encode() and decode() of these ids, with digests of the decimal ids
    joined by commas and of the decoded text in their stead, so that neither leaves the task. Odd rows as there."""
    path = model or model_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = load(path)
        for batch in batches:
            for b in groups(batch, 1, GROUP_BYTES):
                words, number, n = m.words(b.column(1))
                ids, per_word = m.encode_words(words)
                ids = pa.array(ids, pa.int32())
                upto = np.concatenate([[0], np.cumsum(per_word[number])])
                said = _digests(_joined(m.decimal.take(ids), per_word, b","), number, n, b",", 0)
                texts = _digests(_joined(m.text.take(ids), per_word, b""), number, n, b"", 1)
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.diff(upto[np.concatenate([[0], np.cumsum(n)])]), pa.int64()), pa.array(said), pa.array(texts)], ["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema[id_col].dataType.simpleString()
    found = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
    return found.withColumnRenamed("id", id_col)
