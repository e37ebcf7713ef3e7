"""Periodic runs of words, from the branching tandem repeats of a suffix tree.

A run is a stretch of words with a smallest period q (words q apart are equal), at least `least` words and `exponent`
periods long, that no neighbour extends. Every maximal stretch of period D and at least 2 D words ends in just one
branching tandem repeat. In the suffix tree (held as suffix array and intervals of common prefixes, made binary) its two
starts i and i + D part at a node of depth D, so it is enough to look, at each node, from the leaves of the smaller half
into the other half: n log n looks in all, taken as arrays. Repeats are rotated to the left as far as equal words go and
merged by their ends; the least period of a stretch is that of the run.

A run is covered by windows of `least - least // exponent` words that occur twice in it, so stretches without such
windows are left out before any tree is built; this loses nothing. Documents are treated one by one inside their Arrow
batch, nothing is shuffled. Cases: null and empty texts have no words and no runs; rows of a repeated or null key stand
for themselves; an empty table gives an empty one; columns besides key and text are left out. A very long text is
handled whole, in memory of n log n numbers for its repeated stretches.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ASCII_SPACE, slices
from .words import byte_classes, cut_words

TREE_WORDS = 1 << 20
LOOKS = 1 << 21
RUN = "struct<start:long,length:long,period:long>"


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = (a * np.uint64(0x9E3779B97F4A7C15)) ^ (b + np.uint64(0xD1B54A32D192ED03)) * np.uint64(0xBF58476D1CE4E5B9)
    return (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)


def repeated_stretches(codes: np.ndarray, bounds: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of maximal stretches covered by windows that occur twice between two of the ascending bounds."""
    n = len(codes)
    if n < window:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    h, width = codes.astype(np.uint64), 1
    while 2 * width <= window:
        h = _mix(h[: n - 2 * width + 1], h[width : n - width + 1])
        width *= 2
    m = n - window + 1
    h = _mix(h[:m], h[window - width : window - width + m])
    part = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[:m]
    whole = bounds[part + 1] - np.arange(m) >= window
    at = np.flatnonzero(whole)
    keys = _mix(h[at], part[at].astype(np.uint64))
    order = np.argsort(keys)
    same = keys[order[1:]] == keys[order[:-1]]
    twice = np.zeros(len(at), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    at = at[twice]
    delta = np.zeros(n + 1, np.int64)
    np.add.at(delta, at, 1)
    np.add.at(delta, at + window, -1)
    covered = np.cumsum(delta[:-1]) > 0
    first = covered & np.concatenate([[True], ~covered[:-1]])
    first[bounds[:-1][bounds[:-1] < n]] |= covered[bounds[:-1][bounds[:-1] < n]]
    starts = np.flatnonzero(first)
    breaks = np.flatnonzero(~covered | first)
    ends = np.append(breaks, n)[np.searchsorted(breaks, starts, "right")]
    return starts, ends


def _ranks(symbols: np.ndarray) -> list[np.ndarray]:
    """Level k: dense ranks of the strings of 2^k symbols at each place, until all differ."""
    rank = np.unique(symbols, return_inverse=True)[1]
    levels, width, n = [rank.astype(np.int32)], 1, len(symbols)
    while rank.max() < n - 1:
        after = np.zeros(n, np.int64)
        after[: n - width] = rank[width:] + 1
        rank = np.unique(rank.astype(np.int64) * (n + 1) + after, return_inverse=True)[1]
        levels.append(rank.astype(np.int32))
        width *= 2
    return levels


def _common(levels: list[np.ndarray], x: np.ndarray, y: np.ndarray, back: bool = False) -> np.ndarray:
    """Length of what is equal from x and y on, or up to x and y."""
    n, out = len(levels[0]), np.zeros(len(x), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        step = 1 << k
        a, b = (x - out - step + 1, y - out - step + 1) if back else (x + out, y + out)
        fit = (a >= 0) & (b >= 0) & (a < n) & (b < n)
        same = fit.copy()
        same[fit] = levels[k][a[fit]] == levels[k][b[fit]]
        out += same * step
    return out


def _halves(depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For boundaries p of the suffix array: the last one before with depth <= its own, the next one with less."""
    values = depth.tolist()
    before, after, stack = [0] * len(values), [len(values)] * len(values), []
    for p, d in enumerate(values):
        while stack and values[stack[-1]] > d:
            after[stack.pop()] = p
        before[p] = stack[-1] if stack else 0
        stack.append(p)
    return np.array(before, np.int64), np.array(after, np.int64)


def branching_repeats(levels: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(start, half length) of all tandem repeats that the next symbol ends."""
    rank = levels[-1].astype(np.int64)
    n = len(rank)
    order = np.empty(n, np.int64)
    order[rank] = np.arange(n)
    depth = np.concatenate([[0], _common(levels, order[:-1], order[1:])])
    before, after = _halves(depth)
    nodes = np.flatnonzero(depth > 0)
    left, right = nodes - before[nodes], after[nodes] - nodes
    size = np.minimum(left, right)
    low = np.where(left <= right, before[nodes], nodes)
    other, upto = np.where(left <= right, nodes, before[nodes]), np.where(left <= right, after[nodes], nodes)
    starts, halves, done = [], [], 0
    total = np.cumsum(size)
    while done < len(nodes):
        stop = max(done + 1, int(np.searchsorted(total, (total[done - 1] if done else 0) + LOOKS)))
        part = slice(done, stop)
        count = size[part]
        within = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
        spread = lambda v: np.repeat(v[part], count)  # noqa: B023, E731
        i, d = order[spread(low) + within], np.repeat(depth[nodes[part]], count)
        a, b = spread(other), spread(upto)
        for j, start in ((i + d, i), (i - d, i - d)):
            fit = np.flatnonzero((j >= 0) & (j < n))
            r = rank[j[fit]]
            fit = fit[(r >= a[fit]) & (r < b[fit])]
            starts.append(start[fit])
            halves.append(d[fit])
        done = stop
    return (np.concatenate(starts), np.concatenate(halves)) if starts else (np.empty(0, np.int64), np.empty(0, np.int64))


def _runs_of_tree(symbols: np.ndarray, least: int, exponent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    levels = _ranks(symbols)
    at, half = branching_repeats(levels)
    start, end = at - _common(levels, at - 1, at + half - 1, back=True), at + 2 * half
    keep = (end - start >= least) & (end - start >= exponent * half)
    start, end, half = start[keep], end[keep], half[keep]
    order = np.lexsort([half, end, start])
    start, end, half = start[order], end[order], half[order]
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    return start[new], (end - start)[new], half[new]


def find_runs(codes: np.ndarray, bounds: np.ndarray, least: int = 24, exponent: int = 3) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs of the words between two bounds each, by start, then period."""
    window = least - least // exponent
    starts, ends = bounds[:-1].astype(np.int64), bounds[1:].astype(np.int64)
    total = None
    while total is None or (ends - starts).sum() < total:  # what is left may lose its second occurrence
        keep = ends - starts >= least
        starts, ends = starts[keep], ends[keep]
        total = int((ends - starts).sum())
        sizes = ends - starts
        inner = np.concatenate([[0], np.cumsum(sizes)])
        place = np.repeat(starts - inner[:-1], sizes) + np.arange(total)
        a, b = repeated_stretches(codes[place], inner, window)
        starts, ends = (place[a], place[b - 1] + 1) if len(a) else (a, b)
    out = [[], [], []]
    sizes, done = ends - starts, 0
    while done < len(starts):  # each stretch ends in a symbol of its own, so nothing is equal across
        stop = max(done + 1, int(np.searchsorted(np.cumsum(sizes[done:]), TREE_WORDS)) + done)
        n = sizes[done:stop] + 1
        inner = np.cumsum(n) - n
        symbols = np.empty(int(n.sum()), np.int64)
        shift = np.repeat(starts[done:stop] - inner, n)
        last = inner + n - 1
        place = shift + np.arange(len(symbols))
        place[last] = 0
        symbols[:] = codes[place]
        symbols[last] = -1 - np.arange(len(last))
        for held, got in zip(out, _runs_of_tree(symbols, least, exponent)):
            held.append(got if held is not out[0] else got + shift[got])
        done = stop
    start, length, period = (np.concatenate(x) if x else np.empty(0, np.int64) for x in out)
    order = np.lexsort([period, start])
    return start[order], length[order], period[order]


def periodic_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = 24, exponent: int = 3) -> DataFrame:
    """key, n_words, runs (array of start, length, period by start, then period), collapsed: the text whose runs keep
    their first period only, words joined by one space."""
    classes = byte_classes(ASCII_SPACE.encode())

    def run(batches):
        for batch in batches:
            for part in slices(batch, 1 << 22, "_text"):
                words, upto, _ = cut_words(part.column("_text"), classes)
                coded = words.dictionary_encode()
                codes = coded.indices.to_numpy().astype(np.int64)
                start, length, period = find_runs(codes, upto, least, exponent)
                drop = np.zeros(len(codes) + 1, np.int64)
                np.add.at(drop, start + period, 1)
                np.add.at(drop, start + length, -1)
                kept = np.cumsum(drop[:-1]) == 0
                spaced = pc.binary_join_element_wise(coded.dictionary, pa.scalar(b"", pa.large_binary()), pa.scalar(b" ", pa.large_binary())).take(pa.array(codes[kept]))
                ends = np.frombuffer(spaced.buffers()[1], np.int64)[np.concatenate([[0], np.cumsum(kept)])[upto]] if len(spaced) else np.zeros(len(upto), np.int64)
                data = spaced.buffers()[2].to_pybytes() if len(spaced) else b""
                texts = [data[a : max(a, b - 1)].decode() for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
                of = np.searchsorted(upto, start, "right") - 1
                lists = pa.ListArray.from_arrays(
                    pa.array(np.searchsorted(of, np.arange(len(upto))), pa.int32()),
                    pa.StructArray.from_arrays([pa.array(start - upto[of]), pa.array(length), pa.array(period)], ["start", "length", "period"]),
                )
                yield pa.RecordBatch.from_arrays([part.column("_key"), pa.array(np.diff(upto).astype(np.int64)), lists, pa.array(texts, pa.string())], ["_key", "n_words", "runs", "collapsed"])

    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    return rows.mapInArrow(run, f"_key {rows.schema['_key'].dataType.simpleString()}, n_words long, runs array<{RUN}>, collapsed string").withColumnRenamed("_key", key)


_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def planted_text(text: str, draw: int) -> str:
    """The words of a text, periodic from a place on that follows from the draw."""
    words = _WORD.findall(text)
    n, g = len(words), draw // 10
    if not n:
        return text
    first = g % n
    period = 1 + (n - first) // (3 + g % 8)
    tail = words[first : first + period]
    return " ".join(words[:first] + (tail * ((n - first) // period + 1))[: n - first])


def with_planted_runs(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, text: texts as they are, but for the tenth whose key's CRC-32 ends in 0; these are made periodic. A null key
    leaves its text alone."""
    draw = F.crc32(F.col(key).cast("string").cast("binary"))

    @F.pandas_udf("string")
    def plant(texts: pd.Series, draws: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else planted_text(t, int(d)) for t, d in zip(texts, draws)], dtype=object)

    changed = plant(F.when(draw % 10 == 0, F.col(text)), draw)
    return docs.select(F.col(key).alias(key), F.coalesce(changed, F.col(text)).alias("text"))


def best_run(runs: Column) -> Column:
    """The run of greatest length / period, exactly compared; of equals the first by start, then period. Null for none."""
    none = F.lit(None).cast(RUN)
    return F.aggregate(runs, none, lambda best, r: F.when(best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best))


def run_digests(docs: DataFrame) -> DataFrame:
    """The runs of documents with planted periods, as digests."""
    found = periodic_runs(with_planted_runs(docs)).withColumn("best", best_run(F.col("runs")))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))), "")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period", F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
