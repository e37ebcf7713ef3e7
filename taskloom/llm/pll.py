"""Masked pseudo-likelihood by a bidirectional window network trained in numpy.

A word is predicted from the `reach` words on each side of it, itself masked: the embeddings of the neighbours (one
table for each distance and side) are added up, squashed, and give the word's class and then the word in its class,
each by a softmax over 64. The network is trained on every word of the corpus: in each round the tasks train copies of
the last network on their share of that round's documents, and the copies are averaged by weight (parameters travel in
blocks, so no task and not the driver holds more than one network and its sums). Documents are scored by the sum of
the log-probabilities of their words; a word out of the vocabulary has that of the number it shares with others, times
its part of all their occurrences in the corpus.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, scratch, slices
from .words import split_words

SIDE = 64  # classes, and words in a class
SIZE = SIDE * SIDE
ONES = np.ones(SIDE, np.float32)  # a product with it sums rows
LARGEST = 80.0  # e^80 * SIDE and e^-80 are ordinary numbers of 32 bits


class Network:
    def __init__(self, width: int = 16, reach: int = 2, seed: int = 5):
        draw = np.random.default_rng(seed)
        self.width, self.reach = width, reach
        self.places = [k for k in range(-reach, reach + 1) if k]
        self.parameters = {
            "near": draw.normal(0, 0.1, (len(self.places), SIZE, width)).astype(np.float32), "classes": draw.normal(0, 0.1, (SIDE, width)).astype(np.float32),
            "class_bias": np.zeros(SIDE, np.float32), "inside": draw.normal(0, 0.1, (SIDE, width)).astype(np.float32), "inside_bias": np.zeros((SIDE, SIDE), np.float32),
        }

    def flat(self) -> np.ndarray:
        return np.concatenate([v.reshape(-1) for v in self.parameters.values()])

    def load(self, flat: np.ndarray) -> Network:
        at = 0
        for k, v in self.parameters.items():
            self.parameters[k] = flat[at : at + v.size].reshape(v.shape).astype(np.float32)
            at += v.size
        return self

    def _forward(self, line: np.ndarray, at: np.ndarray):
        p = self.parameters
        near = [line[at + k] for k in self.places]
        hidden = np.take(p["near"][0], near[0], axis=0)
        for j, w in enumerate(near[1:], 1):
            hidden += np.take(p["near"][j], w, axis=0)
        np.tanh(hidden, out=hidden)
        word = line[at]
        high, low = word // SIDE, word % SIDE
        first, second = hidden @ p["classes"].T, hidden @ p["inside"].T
        first += p["class_bias"]
        second += np.take(p["inside_bias"], high, axis=0)
        for x, table, bias in ((first, "classes", "class_bias"), (second, "inside", "inside_bias")):
            # no part of hidden is beyond 1, which bounds x; only beyond what exp of 32 bits takes, rows are shifted
            if np.abs(p[table]).sum(axis=1).max() + np.abs(p[bias]).max() > LARGEST:
                x -= x.max(axis=1, keepdims=True)
        return near, hidden, high, low, first, second

    def log_likelihood(self, line: np.ndarray, at: np.ndarray) -> np.ndarray:
        """log p of the words at the given places of a padded line of word numbers."""
        _, _, high, low, first, second = self._forward(line, at)
        rows = np.arange(len(at))
        own = (first[rows, high] + second[rows, low]).astype(np.float64)
        for x in (first, second):
            own -= np.log((np.exp(x, out=x) @ ONES).astype(np.float64))
        return own

    def start_training(self, rate: float = 0.1) -> None:
        self.rate, self.squares = rate, {k: np.full(v.shape, 1e-3, np.float32) for k, v in self.parameters.items()}

    def learn(self, line: np.ndarray, at: np.ndarray) -> None:
        """One step (AdaGrad) on the words at the given places."""
        p, n = self.parameters, np.float32(1 / len(at))
        near, hidden, high, low, first, second = self._forward(line, at)
        rows = np.arange(len(at))
        for x, target in ((first, high), (second, low)):
            np.exp(x, out=x)
            x *= (n / (x @ ONES))[:, None]
            x[rows, target] -= n
        back = (first @ p["classes"] + second @ p["inside"]) * (1 - hidden * hidden)
        self._step("classes", first.T @ hidden)
        self._step("class_bias", first.sum(axis=0))
        self._step("inside", second.T @ hidden)
        which, total = self._sums(high, second)
        self._step("inside_bias", total, which)
        for j, w in enumerate(near):
            which, total = self._sums(w, back)
            self._step("near", total, (j, which))

    @staticmethod
    def _sums(key: np.ndarray, rows: np.ndarray):
        order = np.argsort(key.astype(np.uint16), kind="stable")
        ordered = key[order]
        starts = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
        return ordered[starts], np.add.reduceat(rows[order], starts, axis=0)

    def _step(self, name: str, slope: np.ndarray, which=slice(None)) -> None:
        squares = self.squares[name][which] + slope * slope
        self.squares[name][which] = squares
        self.parameters[name][which] -= self.rate * slope / np.sqrt(squares)


def word_counts(docs: DataFrame) -> DataFrame:
    """word, n of every word of all documents."""

    def count(parts):
        held: dict[bytes, int] = {}

        def rows():
            out = pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], ["word", "n"])
            held.clear()
            return out

        for b in parts:
            for own in slices(b, 4 << 20):
                words, index, _ = split_words(own.column("text"))
                for word, n in zip(words.to_pylist(), np.bincount(index, minlength=len(words)).tolist()):
                    if n:
                        held[word] = held.get(word, 0) + n
                if len(held) > 300_000:
                    yield rows()
        yield rows()

    return docs.select("text").mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def vocabulary(counts: DataFrame, frequent: int) -> dict[bytes, int]:
    """The `frequent` most frequent words, numbered from 1 by count, then by bytes."""
    top = counts.orderBy(F.desc("n"), "word").limit(frequent).collect()  # of fixed size
    return {bytes(r.word): k + 1 for k, r in enumerate(top)}


def word_shares(counts: DataFrame, known: dict[bytes, int], frequent: int) -> DataFrame:
    """h (64-bit hash), share (log of its part of the count of its number) of every word out of the vocabulary."""
    bound = counts.orderBy(F.desc("n"), "word").limit(frequent).select("word")
    own = counts.join(F.broadcast(bound), "word", "left_anti") if known else counts
    own = own.select(F.xxhash64("word").alias("h"), "n").withColumn("number", F.pmod("h", F.lit(SIZE - 1 - frequent)))
    totals = own.groupBy("number").agg(F.sum("n").alias("total"))  # a row for each shared number
    return own.join(F.broadcast(totals), "number").select("h", F.log(F.col("n") / F.col("total")).alias("share"))


def number_words(docs: DataFrame, known: dict[bytes, int], frequent: int) -> DataFrame:
    """row (unique), doc_id, ids (16-bit word numbers), rest (hashes of the words out of the vocabulary, which share the remaining numbers)."""
    shared = SIZE - 1 - frequent

    def run(parts):
        import xxhash
        from pyspark import TaskContext

        row = TaskContext.get().partitionId() << 33
        for b in parts:
            for own in slices(b, 4 << 20):
                words, index, ends = split_words(own.column("text"))
                words = words.to_pylist()
                mark = np.fromiter((xxhash.xxh64_intdigest(w, 42) for w in words), np.uint64, len(words)).view(np.int64)  # as xxhash64 in Spark
                code = np.fromiter((known.get(w) or frequent + 1 + h % shared for w, h in zip(words, mark.tolist())), np.uint16, len(words))
                flat = code[index]
                out = flat > frequent
                rest = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(out)][ends], pa.int32()), pa.array(mark[index[out]], pa.int64()))
                rows = pa.array(range(row, row + own.num_rows), pa.int64())
                row += own.num_rows
                yield pa.RecordBatch.from_arrays([rows, own.column("doc_id"), pa.array([flat[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:])], pa.binary()), rest], ["row", "doc_id", "ids", "rest"])

    return docs.mapInArrow(run, "row long, doc_id long, ids binary, rest array<long>")


def padded(parts: list[np.ndarray], reach: int) -> tuple[np.ndarray, np.ndarray]:
    """(one line with `reach` zeros around each part, places of all words)."""
    gap = np.zeros(reach, np.int64)
    line = np.concatenate([gap, *(x for part in parts for x in (part, gap))])
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    begins = reach + np.cumsum(sizes + reach) - sizes - reach
    return line, np.repeat(begins - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))


def _lines(b: pa.RecordBatch, *keys: str, words: int = 60_000):
    held, total, names = [], 0, []
    for *name, ids in zip(*(b.column(c).to_pylist() for c in (*keys, "ids"))):
        held.append(np.frombuffer(ids, np.uint16).astype(np.int64))
        names.append(name)
        total += len(held[-1]) + 8
        if total >= words:
            yield names, held
            held, total, names = [], 0, []
    if held:
        yield names, held


def train(spark: SparkSession, numbered: DataFrame, width: int = 16, reach: int = 2, rounds: int = 3, step: int = 8192, blocks: int = 32) -> np.ndarray:
    """The parameters of the network after `rounds` rounds, which together see every word once."""
    flat = Network(width, reach).flat()
    for turn in range(rounds):
        share = numbered.where(F.pmod(F.xxhash64("doc_id", "ids"), F.lit(rounds)) == turn)

        def run(parts, flat=flat):
            own, seen = Network(width, reach).load(flat), 0
            own.start_training()
            for b in parts:
                for _, held in _lines(b):
                    line, at = padded(held, reach)
                    for k in range(0, len(at), step):
                        own.learn(line, at[k : k + step])
                    seen += len(at)
            if seen:
                pieces = np.array_split(own.flat(), blocks)
                yield pa.RecordBatch.from_pydict({"block": pa.array(range(blocks), pa.int32()), "n": pa.array([seen] * blocks, pa.int64()), "values": pa.array([x.tobytes() for x in pieces], pa.binary())})

        def average(parts):
            sums, n = {}, {}
            for b in parts:
                for block, weight, values in zip(*(b.column(c).to_pylist() for c in ("block", "n", "values"))):
                    sums[block] = sums.get(block, 0) + weight * np.frombuffer(values, np.float32).astype(np.float64)
                    n[block] = n.get(block, 0) + weight
            for block in sums:
                yield pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int32()), "values": pa.array([(sums[block] / n[block]).astype(np.float32).tobytes()], pa.binary())})

        rows = share.mapInArrow(run, "block int, n long, values binary").repartition(blocks, "block").mapInArrow(average, "block int, values binary").collect()
        if rows:
            flat = np.concatenate([np.frombuffer(r["values"], np.float32) for r in sorted(rows, key=lambda r: r["block"])])
    return flat


def pseudo_likelihood(spark: SparkSession, docs: DataFrame, frequent: int = 3583, width: int = 16, reach: int = 2, rounds: int = 3) -> DataFrame:
    """doc_id, n_words, pll (sum of log p of all words), mean_pll of every row of docs (doc_id, text, any others).

    Words are `[^\\x20\\x09-\\x0D]+` with A-Z in lower case. Null, empty and blank texts have no words, a sum of 0 and a null
    mean. Rows that repeat a doc_id, or have none, are scored one by one. An empty table gives no row.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    counts = materialize(word_counts(rows), scratch(spark, "counts"))
    known = vocabulary(counts, frequent)
    numbered = materialize(number_words(rows, known, frequent), scratch(spark, "numbered"))
    rest = numbered.select("row", F.explode("rest").alias("h")).join(word_shares(counts, known, frequent), "h").groupBy("row").agg(F.sum("share").alias("share"))
    scored = score(numbered, train(spark, numbered.select("doc_id", "ids"), width, reach, rounds), width, reach)
    pll = F.col("pll") + F.coalesce("share", F.lit(0.0))
    return scored.join(rest, "row", "left").select("doc_id", "n_words", pll.alias("pll"), F.when(F.col("n_words") > 0, pll / F.col("n_words")).alias("mean_pll"))


def score(numbered: DataFrame, flat: np.ndarray, width: int, reach: int) -> DataFrame:
    """row, doc_id, n_words, pll: the sum of log p of the numbers of all words."""

    def run(parts):
        own = Network(width, reach).load(flat)
        for b in parts:
            for names, held in _lines(b, "row", "doc_id"):
                line, at = padded(held, reach)
                value = np.concatenate([own.log_likelihood(line, at[k : k + 2048]) for k in range(0, len(at), 2048)] or [np.empty(0)])
                sizes = [len(x) for x in held]
                total = [math.fsum(value[e - n : e]) for n, e in zip(sizes, np.cumsum(sizes).tolist())]
                rows, ids = zip(*names)
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(total, pa.float64())], ["row", "doc_id", "n_words", "pll"])

    return numbered.select("row", "doc_id", "ids").mapInArrow(run, "row long, doc_id long, n_words long, pll double")
