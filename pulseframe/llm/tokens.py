"""Pieces of a public tokenizer, looked up word by word.

The vocabulary splits texts at white space before anything else, so the pieces of a text are those of its words in turn,
and each word needs the library once. Splitting is at ASCII white space alone: whatever else the library takes for
space stays inside a word and is left to the library. Special strings hold no white space, so they too stay whole.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import pyarrow as pa

from .words import words_of

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Words kept by a worker; beyond it a new table is begun, into which words of the one before are taken when they come up.
KEPT_WORDS = 550_000
_ENDED = re.compile(rb"(?:[0-9A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])[.,]$")
_LETTERS = re.compile(rb"(?:[a-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def load(path: str):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    return tok


class WordPieces:
    """For a vocabulary that lower-cases, splits letters from marks and marks the last piece of a word. Words have numbers,
    by which their ids are found in one array; texts are split and their distinct words found in Arrow, so that Python
    sees each distinct word of a group of texts once."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tok = load(path)
        # words of plain letters need no more than the merges
        self.merges = Tokenizer(self.tok.model)
        self.merges.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        n = self.tok.get_vocab_size()
        self.dtype = np.dtype("<u2" if n <= 65536 else "<u4")
        self.last = np.zeros(n, bool)
        for piece, i in self.tok.get_vocab().items():
            self.last[i] = piece.endswith("</w>")
        self.number: dict[bytes, int] = {}
        self.flat, self.ends = np.zeros(1 << 16, self.dtype), np.zeros(1 << 14, np.int64)
        self.older: tuple[dict[bytes, int], np.ndarray, np.ndarray] | None = None

    def _add(self, words: list[bytes], ids: np.ndarray, lens: np.ndarray) -> None:
        n, at = len(self.number), int(self.ends[len(self.number) - 1]) if self.number else 0
        if at + len(ids) > len(self.flat):
            self.flat = np.concatenate((self.flat[:at], np.zeros(max(at, len(ids)) + len(ids), self.dtype)))
        if n + len(words) > len(self.ends):
            self.ends = np.concatenate((self.ends[:n], np.zeros(max(n, len(words)) + len(words), np.int64)))
        self.flat[at : at + len(ids)] = ids
        self.ends[n : n + len(words)] = at + np.cumsum(lens)
        self.number.update(zip(words, range(n, n + len(words)), strict=True))

    def _encode(self, words: list[bytes]) -> None:
        """Words of ASCII and Latin-1 letters alone, which are one pre-token each, by the line; others one by one."""
        plain = [w for w in words if _LETTERS.fullmatch(w)]
        lines = [plain[at : at + 100] for at in range(0, len(plain), 100)]
        for at in range(0, len(lines), 200):
            part = lines[at : at + 200]
            for own, e in zip(part, self.merges.encode_batch_fast([b" ".join(x).decode().lower() for x in part], add_special_tokens=False), strict=True):
                ids = np.array(e.ids, self.dtype)
                ends = np.nonzero(self.last[ids])[0] + 1
                if len(ends) == len(own):
                    self._add(own, ids, np.diff(ends, prepend=0))
        rest = [w for w in words if w not in self.number]
        for at in range(0, len(rest), 20_000):
            part = rest[at : at + 20_000]
            found = [e.ids for e in self.tok.encode_batch_fast([w.decode() for w in part], add_special_tokens=False)]
            lens = np.fromiter(map(len, found), np.int64, len(found))
            self._add(part, np.fromiter(chain.from_iterable(found), self.dtype, int(lens.sum())), lens)

    def _learn(self, words: list[bytes]) -> None:
        if self.older:
            number, flat, ends = self.older
            met = [w for w in words if w in number]
            self._add(met, *_gather(flat, ends, np.fromiter(map(number.__getitem__, met), np.int64, len(met))))
            words = [w for w in words if w not in self.number]
        # a sentence's end or a comma after a letter or digit is a pre-token of its own
        ended = [w for w in words if w[-1:] in (b".", b",") and _ENDED.search(w)]
        parts = {x for w in ended for x in (w[:-1], w[-1:])}
        self._encode(list(parts.union(words).difference(ended).difference(self.number)))
        ended = [w for w in ended if w not in self.number]
        get = self.number.__getitem__
        both = np.fromiter((x for w in ended for x in (get(w[:-1]), get(w[-1:]))), np.int64, 2 * len(ended))
        ids, lens = _gather(self.flat, self.ends, both)
        self._add(ended, ids, lens[::2] + lens[1::2])

    def many(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of a few texts, one after the other, and how many each has. Nulls count as empty."""
        # the vocabulary is lower-case; a special string counts only as it is written
        names, held, n = words_of(texts, keep_special=True)
        number = np.fromiter(map(self.number.get, names, repeat(-1)), np.int64, len(names))
        new = np.nonzero(number < 0)[0].tolist()
        if len(self.number) + len(new) > KEPT_WORDS:
            self.older = (self.number, self.flat, self.ends)
            self.number, self.flat, self.ends = {}, np.zeros_like(self.flat), np.zeros_like(self.ends)
            new = range(len(names))
        if new:
            self._learn([names[i] for i in new])
            number[new] = np.fromiter(map(self.number.__getitem__, map(names.__getitem__, new)), np.int64, len(new))
        ids, lens = _gather(self.flat, self.ends, number[held])
        upto = np.concatenate(([0], np.cumsum(lens)))
        return ids, np.diff(upto[np.concatenate(([0], np.cumsum(n)))])

    def ids(self, text: bytes) -> bytes:
        return self.many(pa.array([text], pa.binary()))[0].tobytes()


def _gather(flat: np.ndarray, ends: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids of the words with these numbers in turn, how many each has)."""
    starts = np.where(number > 0, ends[number - 1], 0)
    lens = ends[number] - starts
    upto = np.cumsum(lens)
    return flat[np.arange(int(upto[-1]) if len(upto) else 0) + np.repeat(starts - (upto - lens), lens)], lens


@lru_cache(maxsize=1)
def word_pieces(path: str) -> WordPieces:
    """One table for all tasks of a Python worker."""
    return WordPieces(path)
