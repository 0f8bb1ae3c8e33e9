"""White-space-delimited words of whole texts, split and told apart in Arrow."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are handled at once.
GROUP_BYTES = 3 << 20


def groups(batch: pa.RecordBatch, column: int, size: int = GROUP_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in slices whose texts have about so many bytes; a longer text is a slice of its own."""
    held = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(held, (held[at - 1] if at else 0) + size, side="right")))
        yield batch.slice(at, to - at)
        at = to


def names_of(words: pa.Array) -> list[bytes]:
    """Words without white space as Python has them, by one split rather than one by one."""
    joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words), " ")[0].as_py().encode()
    found = joined.split(b" ")
    return found if len(found) == len(words) else words.cast(pa.binary()).to_pylist()


def words_of(texts: pa.Array, keep_special: bool = False) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """(distinct words, for each word its number among them, words of each text): words are lower-cased (A-Z) and stand
    between ASCII white space. Nulls count as empty. With keep_special texts that hold the opening of a special string stay
    as they are."""
    texts = pc.fill_null(texts.cast(pa.string()), "")
    low = pc.ascii_lower(texts)
    split = pc.ascii_split_whitespace(pc.if_else(pc.match_substring(texts, "<|"), texts, low) if keep_special else low)
    held = split.flatten().dictionary_encode()
    number, n = held.indices.to_numpy().astype(np.int64), np.diff(split.offsets.to_numpy()).astype(np.int64)
    if not len(number):
        return [], number, n
    names = names_of(held.dictionary)
    if b"" in names:  # before the first and behind the last space of a text
        none = names.index(b"")
        real = number != none
        n = np.add.reduceat(np.append(real, False).astype(np.int64), np.minimum(np.cumsum(n) - n, len(real))) * (n > 0)
        number = number[real]
        number -= number > none
        del names[none]
    return names, number, n


def counted(texts: pa.Array) -> tuple[pa.Array, pa.Array]:
    """(distinct words of the texts, how often each stands there)."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts.cast(pa.string()), ""))).flatten()
    found = pc.value_counts(split)
    real = pc.not_equal(found.field("values"), "")
    return found.field("values").filter(real), found.field("counts").filter(real)
