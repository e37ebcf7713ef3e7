"""Words `[^\\x20\\x09-\\x0D]+` of many texts at once, by Arrow's string kernels."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def split_words(texts: pa.Array, lower: bool = True) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(distinct words as bytes, index of each word of all texts, words before each text and in all).

    Lower-casing is that of A-Z alone; null texts have no words.
    """
    cut = pc.ascii_split_whitespace(pc.ascii_lower(texts) if lower else texts)
    counts = pc.fill_null(pc.list_value_length(cut), 0).to_numpy(zero_copy_only=False)
    coded = cut.flatten().dictionary_encode()
    index = coded.indices.to_numpy().astype(np.int64)
    words = coded.dictionary.cast(pa.binary())
    ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
    empty = np.flatnonzero(pc.equal(pc.binary_length(words), 0).to_numpy(zero_copy_only=False))
    if len(empty):  # white space at an end of a text leaves an empty string
        keep = ~np.isin(index, empty)
        ends = np.concatenate([[0], np.cumsum(keep)])[ends]
        index = index[keep]
    return words, index, ends


def hashed_words(texts: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hashes of all words one after another, words before each text and in all)."""
    import xxhash

    words, index, ends = split_words(texts, lower)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words.to_pylist()), np.uint64, len(words))
    return hashes[index], ends


def byte_classes(*groups: bytes) -> np.ndarray:
    """Class of each byte: 0 inside words, 1 for the first group of separators, 2 for the second, ..."""
    out = np.zeros(256, np.uint8)
    for k, group in enumerate(groups):
        out[list(group)] = k + 1
    return out


def cut_words(texts: pa.Array, classes: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(all words one after another as bytes, words before each text and in all, piece of each word).

    Separators are ASCII bytes; those of class 2, and the ends of texts, end pieces as well (a line feed has to be a
    separator). Null texts have no words.
    """
    joined = pc.binary_join_element_wise(pc.fill_null(texts.cast(pa.large_string()), ""), pa.scalar("", pa.large_string()), pa.scalar("\n", pa.large_string()))
    where = np.frombuffer(joined.buffers()[1], np.int64)[joined.offset : joined.offset + len(joined) + 1] if len(joined) else np.zeros(1, np.int64)
    data = np.frombuffer(joined.buffers()[2], np.uint8)[where[0] : where[-1]] if len(joined) else np.zeros(0, np.uint8)
    kinds = classes[data]
    inside = kinds == 0
    edge = np.diff(np.concatenate([[0], inside.view(np.int8)]))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[inside])])
    ends_of_pieces = np.flatnonzero(kinds == 2)
    return words, np.searchsorted(starts, where - where[0]), np.searchsorted(ends_of_pieces, starts)
