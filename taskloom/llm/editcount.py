"""Edit-aware token counts: a segment tree over the white-space-delimited runs of a document.

A leaf is a run with the white space after it and holds its bytes and number of tokens; inner nodes hold sums of both.
An edit finds its leaves by descending along byte sums, re-encodes the joined text of the touched leaves alone (with
the next leaf where no white space is left between them) and updates the sums on the way up.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import slices
from .encode import encoder as shared_encoder

SPACE = b" \t\n\r\x0b\x0c"
_IS_SPACE = np.isin(np.arange(256), list(SPACE))


class CountTree:
    """Token count of a text under edits. tokens: counts of the runs, or a function that counts the tokens of a text."""

    def __init__(self, text: bytes, count, run_tokens: np.ndarray | None = None):
        self.count, self.encoded_bytes = count, 0
        data = np.frombuffer(text, np.uint8)
        space = _IS_SPACE[data]
        starts = np.flatnonzero(~space & np.r_[True, space[:-1]]) if len(data) else np.empty(0, np.int64)
        edges = np.concatenate([[0], starts[1:], [len(text)]]).astype(np.int64) if len(starts) else np.array([0, len(text)])
        self.leaves: list[bytes] = [text[a:b] for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())]
        if run_tokens is None or len(run_tokens) != len(starts):
            run_tokens = np.array([self._encode(x) for x in self.leaves], np.int64)
        elif not len(starts):
            run_tokens = np.zeros(1, np.int64)
        self.n = 1 << max(0, (len(self.leaves) - 1).bit_length())
        sums = np.zeros((2 * self.n, 2), np.int64)
        sums[self.n : self.n + len(self.leaves), 0] = run_tokens
        sums[self.n : self.n + len(self.leaves), 1] = np.diff(edges)
        half = self.n
        while half > 1:
            sums[half // 2 : half] = sums[half : 2 * half].reshape(-1, 2, 2).sum(axis=1)
            half //= 2
        self.tokens, self.size = sums[:, 0].tolist(), sums[:, 1].tolist()

    def _encode(self, text: bytes) -> int:
        self.encoded_bytes += len(text)
        return self.count(text.decode("utf-8", "replace"))

    @property
    def total(self) -> int:
        return self.tokens[1]

    @property
    def length(self) -> int:
        return self.size[1]

    def text(self) -> bytes:
        return b"".join(self.leaves)

    def _leaf(self, at: int) -> tuple[int, int]:
        """(leaf, offset in it) of a byte; the end of the text belongs to the last leaf that is not empty."""
        node = 1
        while node < self.n:
            node *= 2
            if at >= self.size[node] and self.size[node + 1]:
                at -= self.size[node]
                node += 1
        return node - self.n, at

    def _set(self, leaf: int, text: bytes, tokens: int) -> None:
        self.leaves[leaf] = text
        node = leaf + self.n
        more, longer = tokens - self.tokens[node], len(text) - self.size[node]
        while node:
            self.tokens[node] += more
            self.size[node] += longer
            node //= 2

    def edit(self, start: int, end: int, replacement: bytes) -> None:
        """Replace the bytes from start to end, places counting in the text as it is now."""
        if not 0 <= start <= end <= self.length:
            raise ValueError("the edit lies outside the text")
        first, before = self._leaf(start)
        last, after = self._leaf(end)
        made = self.leaves[first][:before] + replacement + self.leaves[last][after:]
        if before == 0 and first:
            # what comes to stand at the beginning of a leaf may continue the one before
            previous = self._previous(first)
            if previous is not None and self.leaves[previous][-1] not in SPACE:
                first, made = previous, self.leaves[previous] + made
        while made and made[-1] not in SPACE and (following := self._next(last)) is not None:
            last, made = following, made + self.leaves[following]
        for leaf in range(first + 1, last + 1):
            if self.leaves[leaf]:
                self._set(leaf, b"", 0)
        self._set(first, made, self._encode(made))

    def _previous(self, leaf: int) -> int | None:
        return next((k for k in range(leaf - 1, -1, -1) if self.leaves[k]), None)

    def _next(self, leaf: int) -> int | None:
        return next((k for k in range(leaf + 1, len(self.leaves)) if self.leaves[k]), None)


def scrub_edits(text: bytes) -> list[tuple[int, int, bytes]]:
    """Edits of a usual scrub, by place in the original: lines that repeat an earlier line go, digit runs become one 0."""
    edits, seen, at = [], set(), 0
    for line in text.split(b"\n"):
        if line.strip() and line in seen:
            edits.append((max(0, at - 1), at + len(line), b""))
        else:
            seen.add(line)
            edits += [(at + m.start(), at + m.end(), b"0") for m in re.finditer(rb"[0-9]+", line)]
        at += len(line) + 1
    return edits


def count_under_edits(spark: SparkSession, docs: DataFrame, vocabulary: str = "word_bpe_49k.json", edits=scrub_edits) -> DataFrame:
    """doc_id, n_tokens, n_edits, n_tokens_after, encoded_bytes (re-encoded for the edits) of every row of docs.

    edits(text bytes) gives non-overlapping (start, end, replacement), in order and by place in the original; edges
    must not cut a character. Null texts count as empty; repeated doc_ids and null ones are rows like others.
    """

    def run(parts):
        encoder = None
        for b in parts:
            for held in slices(b, 4 << 20):
                encoder = encoder or shared_encoder(vocabulary)
                tokens, runs = encoder.run_sizes(held.column("text"))
                rows, at = [], 0
                for name, text, n in zip(held.column("doc_id").to_pylist(), held.column("text").to_pylist(), runs.tolist()):
                    own, raw = tokens[at : at + n], text.encode("utf-8", "surrogatepass")
                    at += n
                    todo = edits(raw)
                    if not todo:
                        rows.append((name, int(own.sum()), 0, int(own.sum()), 0))
                        continue
                    tree = CountTree(raw, lambda x: int(encoder.encode_batch([x])[1][0]), own)
                    before = tree.total
                    for start, end, new in reversed(todo):
                        tree.edit(start, end, new)
                    rows.append((name, before, len(todo), tree.total, tree.encoded_bytes))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], ["doc_id", "n_tokens", "n_edits", "n_tokens_after", "encoded_bytes"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, n_edits long, n_tokens_after long, encoded_bytes long")
