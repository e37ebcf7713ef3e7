"""Byte-level BPE by a queue of merge ranks over a doubly linked list of symbols, and its inverse.

`encode` gives every text the ids that the tokenizers library gives it (special strings of the vocabulary stand for
their own id, no template around); `decode` concatenates the vocabulary's strings. Both go row by row in Arrow batches
and shuffle nothing. Cases: a null text counts as empty and has no ids; rows of a repeated or null key are each treated
on their own; an empty table gives an empty one; columns besides key and text are left out, so none can clash. Very
long texts are cut into windows where no token can span the cut; only a run without white space is held whole.
"""

from __future__ import annotations

import json
import re
import unicodedata
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices
from .encode import Encoder, _byte_letters, vocabulary_path

VOCABULARY = "byte_bpe_50k.json"
WINDOW = 1 << 20


def pre_token_pattern(letters: str = r"\p{L}", numbers: str = r"\p{N}") -> str:
    """The published pattern of the byte-level family: contractions, letters, numbers, other marks, white space."""
    return rf"'(?:[sdmt]|ll|ve|re)| ?{letters}+| ?{numbers}+| ?(?:(?!{letters}|{numbers})\S)+|\s+(?!\S)|\s+"


def _ranges(chars: list[str]) -> str:
    """Ascending characters as the inside of a regex class."""
    codes = np.array([*map(ord, chars)], np.int64)
    parts = np.split(codes, np.flatnonzero(np.diff(codes) > 1) + 1) if len(codes) else []
    return "".join(rf"\U{p[0]:08x}-\U{p[-1]:08x}" for p in parts)


class BytePairs(Encoder):
    """pieces(text) cuts a text, encode_texts(texts) gives ids; runs seen before come from the cache of Encoder."""

    def __init__(self, vocabulary: str, cached_runs: int = 400_000):
        with open(vocabulary_path(vocabulary), encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec["pre_tokenizer"]
        odd = [t["content"] for t in spec["added_tokens"] if t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]]
        if odd or spec["normalizer"] or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or model["ignore_merges"] or model["dropout"]:
            raise ValueError(f"{vocabulary} is not a plain byte-level BPE")
        self.vocab = model["vocab"]
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        self.merges, self.made = {}, []  # rank of a pair, what it becomes by rank
        for rank, (a, b) in enumerate(pairs):
            self.merges[self.vocab[a] << 32 | self.vocab[b]] = rank
            self.made.append(self.vocab[a + b])
        letters = {b: chr(n) for b, n in ({b: b for b in range(256)} | _byte_letters()).items()}
        self.first = [self.vocab[letters[b]] for b in range(256)]
        self.bytes_of = {c: b for b, c in letters.items()}
        self.cached_runs = cached_runs
        self.special = re.compile("|".join(map(re.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None
        self._patterns(vocabulary)
        self._reset()

    def _patterns(self, vocabulary: str) -> None:
        """The pattern, and one for texts with characters that newer Unicode tables class as letters or numbers: of these the library is asked."""
        import regex
        from tokenizers import Tokenizer

        unassigned = "".join(c for c in map(chr, (*range(0xD800), *range(0xE000, 0x110000))) if unicodedata.category(c) == "Cn")
        doubtful = regex.findall(r"[\p{L}\p{N}]", unassigned)
        cut = Tokenizer.from_file(vocabulary_path(vocabulary)).pre_tokenizer.pre_tokenize_str
        kinds = {c: [end for _, (_, end) in cut(f"a{c}1")] for c in doubtful}
        new, joined, counted = _ranges(doubtful), _ranges([c for c in doubtful if kinds[c] == [2, 3]]), _ranges([c for c in doubtful if kinds[c] == [1, 3]])
        either = lambda base, more: rf"(?:(?![{new}]){base}{f'|[{more}]' if more else ''})"
        self.pattern = regex.compile(pre_token_pattern())
        self.careful = regex.compile(pre_token_pattern(either(r"\p{L}", joined), either(r"\p{N}", counted))) if doubtful else self.pattern
        self.doubtful = np.zeros(1 << 16, bool)
        self.doubtful[0xD800:0xE000] = True  # halves of characters beyond 16 bits
        self.doubtful[[ord(c) for c in doubtful if ord(c) < 1 << 16]] = True
        self.edge = regex.compile(r"(?<=\S)(?=\s)")

    def merge(self, word: bytes) -> list[int]:
        """Ids of one piece: always the pair of least rank, the leftmost of equals."""
        ids, n, get, new = [self.first[b] for b in word], len(word), self.merges.get, self.made
        # queue entries are rank * 2^32 + place, the order of ranks and then of places
        queue = [rank << 32 | k for k, pair in enumerate(zip(ids, ids[1:])) if (rank := get(pair[0] << 32 | pair[1])) is not None]
        if not queue:
            return ids
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        heapify(queue)
        while queue:
            top = heappop(queue)
            k = top & 0xFFFFFFFF
            left, j = ids[k], after[k]
            if left < 0 or j < 0 or get(left << 32 | ids[j]) != top >> 32:
                continue  # stale: a neighbour has changed since
            ids[k], ids[j] = made, _ = new[top >> 32], -1
            after[k] = right = after[j]
            if right >= 0:
                before[right] = k
                if (rank := get(made << 32 | ids[right])) is not None:
                    heappush(queue, rank << 32 | k)
            left = before[k]
            if left >= 0 and (rank := get(ids[left] << 32 | made)) is not None:
                heappush(queue, rank << 32 | left)
        return [i for i in ids if i >= 0]

    def _encode(self, words: list[str]) -> list[list[int]]:
        return [self.merge(w.encode()) for w in words]

    def windows(self, text: str):
        """Parts of a text, cut before white space that follows something else."""
        at = 0
        while len(text) - at > WINDOW:
            cut = self.edge.search(text, at + WINDOW)
            if cut is None:
                break
            yield text[at : cut.start()]
            at = cut.start()
        yield text[at:] if at else text

    def pieces(self, text: str) -> list[str]:
        plain = text.isascii() or not self.doubtful[np.frombuffer(text.encode("utf-16-le"), np.uint16)].any()
        return (self.pattern if plain else self.careful).findall(text)

    def _known(self, pieces: list[str]) -> np.ndarray:
        codes = np.fromiter(map(self.code.get, pieces, repeat(-1)), np.int64, len(pieces))
        missing = np.flatnonzero(codes < 0)
        if len(missing):
            new = list(dict.fromkeys(pieces[k] for k in missing.tolist()))
            self._learn(new)
            codes[missing] = np.fromiter(map(self.code.__getitem__, (pieces[k] for k in missing.tolist())), np.int64, len(missing))
        self.hits[codes] += 1
        return codes

    def _ids_of(self, text: str) -> list[np.ndarray]:
        if len(self.code) > self.cached_runs or self.used > 16 * self.cached_runs:
            self._make_room()
        codes = self._known(self.pieces(text))
        sizes = self.size[codes]
        ends = np.cumsum(sizes)
        at = np.repeat(self.start[codes] - (ends - sizes), sizes) + np.arange(int(ends[-1]) if len(ends) else 0)
        return [self.flat[at]]

    def encode_text(self, text: str | None) -> np.ndarray:
        out, at = [np.empty(0, np.uint32)], 0
        text = text or ""
        for found in self.special.finditer(text) if self.special else ():
            for window in self.windows(text[at : found.start()]):
                out += self._ids_of(window)
            out.append(np.array([self.added[found.group()]], np.uint32))
            at = found.end()
        for window in self.windows(text[at:] if at else text):
            out += self._ids_of(window)
        return np.concatenate(out)

    def strings(self) -> pa.Array:
        """The bytes of every id; ids that the vocabulary lacks are empty."""
        table = self.vocab | self.added
        out = [b""] * (max(table.values()) + 1)
        for token, k in table.items():
            out[k] = bytes(self.bytes_of[c] for c in token) if all(c in self.bytes_of for c in token) else token.encode()
        return pa.array(out, pa.large_binary())


@lru_cache(maxsize=2)
def byte_pairs(vocabulary: str) -> BytePairs:
    """The process's encoder: later tasks of the same Python worker find the cache filled."""
    return BytePairs(vocabulary)


@lru_cache(maxsize=2)
def id_strings(vocabulary: str) -> pa.Array:
    return byte_pairs(vocabulary).strings()


def encode(docs: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """key, ids (array of int) of every whole text."""

    def run(batches):
        pairs = byte_pairs(vocabulary)
        for batch in batches:
            for part in slices(batch, 1 << 21, "_text"):
                got = [pairs.encode_text(t) for t in part.column("_text").to_pylist()]
                ends = np.concatenate([[0], np.cumsum([len(x) for x in got])])
                ids = pa.array(np.concatenate(got).astype(np.int32))
                yield pa.RecordBatch.from_arrays([part.column("_key"), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), ids)], ["_key", "ids"])

    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    return rows.mapInArrow(run, f"_key {rows.schema['_key'].dataType.simpleString()}, ids array<int>").withColumnRenamed("_key", key)


def decode(encoded: DataFrame, key: str = "doc_id", ids: str = "ids", vocabulary: str = VOCABULARY) -> DataFrame:
    """key, text: the vocabulary's strings one after another; bytes that are no UTF-8 become U+FFFD. Null ids: null.

    Ids that the vocabulary lacks stand for nothing, as in the library.
    """

    def run(batches):
        strings = id_strings(vocabulary)
        for batch in batches:
            lists = batch.column("_ids")
            flat = np.asarray(lists.flatten())
            sizes = np.array([0 if n is None else n for n in pa.compute.list_value_length(lists).to_pylist()], np.int64)
            known = (flat >= 0) & (flat < len(strings))
            upto = np.concatenate([[0], np.cumsum(known)])[np.concatenate([[0], np.cumsum(sizes)])]
            joined = strings.take(pa.array(flat[known]))
            where = np.frombuffer(joined.buffers()[1], np.int64)[upto + joined.offset].tolist() if len(joined) else [0] * len(upto)
            data = joined.buffers()[2].to_pybytes() if len(joined) else b""
            texts = [data[a:b].decode("utf-8", "replace") if ok else None for a, b, ok in zip(where[:-1], where[1:], lists.is_valid().to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("_key"), pa.array(texts, pa.string())], ["_key", "text"])

    rows = encoded.select(F.col(key).alias("_key"), F.col(ids).alias("_ids"))
    return rows.mapInArrow(run, f"_key {rows.schema['_key'].dataType.simpleString()}, text string").withColumnRenamed("_key", key)


def round_trip(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (of decimal ids joined by commas), decoded_sha256, of ids and of the text made from them."""
    ids = encode(docs, vocabulary=vocabulary)
    coded = ids.select(F.struct("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256")).alias("row"), "ids")
    return decode(coded, "row", vocabulary=vocabulary).select("row.*", F.sha2("text", 256).alias("decoded_sha256"))
