"""Benchmark decontamination by greedy string tiling.

Documents and items that share a seed (`least` words in a row) are joined; for each such pair running Karp-Rabin finds
the longest common runs of words that are not yet marked, marks them as tiles and goes on with shorter ones down to
`least` words. The share of the item's words under tiles is its coverage, whatever the order of the passages.
"""

from __future__ import annotations

from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import identified, materialize, reading, scratch, slices
from .jaccard import mix
from .words import hashed_words

U = np.uint64
ODD = U(0x9E3779B97F4A7C15)


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Karp-Rabin hashes (modulo 2^64) of all windows of `size` words."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, U)
    total = np.zeros(n, U)
    for k in range(size):
        total = total * ODD + words[k : k + n]
    return mix(total)


def greedy_tiles(item: np.ndarray, text: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Tiles (place in item, place in text, words) by running Karp-Rabin, longest first."""
    least = max(1, min(least, len(item)))
    free_item, free_text = np.ones(len(item), bool), np.ones(len(text), bool)
    tiles, size = [], min(len(item), len(text))
    if size < least:
        return []
    size = min(size, 4 * least)
    while True:
        matches = _scan(item, text, free_item, free_text, size)
        longest = max((m[2] for m in matches), default=0)
        if longest > 2 * size and size < min(len(item), len(text)):
            size = longest
            continue
        queue = [(-n, p, t) for p, t, n in matches]
        heapify(queue)
        while queue:
            n, p, t = heappop(queue)
            free = free_item[p : p - n] & free_text[t : t - n]
            if free.all():
                free_item[p : p - n] = free_text[t : t - n] = False
                tiles.append((p, t, -n))
            else:  # a longer one covers a part; what is left takes its turn by its own length
                edge = np.flatnonzero(np.diff(np.concatenate([[0], free.view(np.int8), [0]])))
                for low, high in zip(edge[::2].tolist(), edge[1::2].tolist()):
                    if high - low >= size:
                        heappush(queue, (low - high, p + low, t + low))
        if size == least:
            return tiles
        size = max(least, size // 2)


def _scan(item, text, free_item, free_text, size):
    """Maximal matches of at least `size` unmarked words."""
    a, b = window_hashes(item, size), window_hashes(text, size)
    if not len(a) or not len(b):
        return []

    def open_(free, n):
        total = np.concatenate([[0], np.cumsum(free)])
        return total[size : size + n] - total[:n] == size

    ok_a, ok_b = np.flatnonzero(open_(free_item, len(a))), np.flatnonzero(open_(free_text, len(b)))
    order = ok_a[np.argsort(a[ok_a], kind="stable")]
    low, high = np.searchsorted(a[order], b[ok_b], "left"), np.searchsorted(a[order], b[ok_b], "right")
    out = []
    for t, x, y in zip(ok_b[high > low].tolist(), low[high > low].tolist(), high[high > low].tolist()):
        for p in order[x:y].tolist():
            before = p and t and free_item[p - 1] and free_text[t - 1] and item[p - 1] == text[t - 1]
            if before or not (item[p : p + size] == text[t : t + size]).all():
                continue
            n = size
            while p + n < len(item) and t + n < len(text) and free_item[p + n] and free_text[t + n] and item[p + n] == text[t + n]:
                n += 1
            out.append((p, t, n))
    return out


class Items:
    """The benchmark items as word hashes, and their seeds."""

    def __init__(self, rows: list[tuple[int, str | None]], least: int):
        rows = sorted((i, t or "") for i, t in rows if i is not None)
        self.least, self.ids = least, [i for i, _ in rows]
        flat, ends = hashed_words(pa.array([t for _, t in rows], pa.string()))
        self.words = [flat[a:b] for a, b in zip(ends[:-1], ends[1:])]
        seeds: dict[int, list[tuple[U, int]]] = {}
        for k, words in enumerate(self.words):
            size = min(least, len(words))
            if size:
                seeds.setdefault(size, []).extend((h, k) for h in np.unique(window_hashes(words, size)))
        self.tables = {}
        for size, own in seeds.items():
            hashes, owner = np.array([h for h, _ in own], U), np.array([k for _, k in own], np.int64)
            order = np.argsort(hashes, kind="stable")
            cells = np.zeros(1 << 20, bool)
            cells[(hashes >> U(44)).astype(np.int64)] = True
            self.tables[size] = hashes[order], owner[order], cells

    def candidates(self, flat: np.ndarray, ends: np.ndarray):
        """(text number, item number) of all pairs that share a seed."""
        found = [np.empty((0, 2), np.int64)]
        for size, (hashes, owner, cells) in self.tables.items():
            own = window_hashes(flat, size)
            at = np.flatnonzero(cells[(own >> U(44)).astype(np.int64)])
            text = np.searchsorted(ends, at, "right") - 1
            inside = at + size <= ends[text + 1]
            at, text = at[inside], text[inside]
            low, high = np.searchsorted(hashes, own[at], "left"), np.searchsorted(hashes, own[at], "right")
            many = high - low
            row = np.repeat(np.arange(len(at)), many)
            place = np.repeat(low - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
            found.append(np.unique(np.stack([text[row], owner[place]], axis=1), axis=0))
        return np.unique(np.concatenate(found), axis=0)


SCHEMA = "doc_id long, item_id long, item_words long, covered_words long, n_tiles long"


def tile_coverage(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, least: int = 5, coverage: float = 0.5, most_items_bytes: int = 32 << 20) -> DataFrame:
    """doc_id, item_id, item_words, covered_words, n_tiles of the pairs with covered_words >= coverage * item_words.

    Words are `[^\\x20\\x09-\\x0D]+` with A-Z in lower case, texts are taken whole. Items of fewer than `least` words must
    occur as a whole; items and documents without words, with null text or (items) null id match nothing. Rows that
    repeat an id count as items or documents of their own; equal result rows stay. Either table empty: no rows. Items
    are written to the shared folder in blocks of some `most_items_bytes` (at least one item); the tasks of a pass over
    the documents read one block, and the driver holds file names only.
    """
    items = benchmark.where("item_id is not null").select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    size = items.agg(F.sum(F.octet_length("text") + F.lit(16))).first()[0] or 0
    blocks = int(size // most_items_bytes + 1)
    folder = scratch(spark, "items")
    dealt = items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)).cast("int"))
    dealt.repartition(blocks, "block").write.partitionBy("block").parquet(folder)
    files: dict[str, list[str]] = {}
    for path in spark.read.schema("item_id long, text string, block int").parquet(folder).inputFiles():
        files.setdefault(path.split("/block=")[-1].split("/")[0], []).append(path)
    out = None
    for block in sorted(files) or [None]:
        part = rows.mapInArrow(_tiler(tuple(sorted(files.get(block, ()))), least, coverage), SCHEMA)
        out = part if out is None else out.unionAll(part)
    return out


@lru_cache(maxsize=1)
def _items(files: tuple[str, ...], least: int) -> Items:
    """The items of one block, read from the shared folder; a Python worker keeps the last block for its next task."""
    rows = []
    for path in files:
        with reading(path) as stream:
            # without threads and read-ahead buffers, which a Python worker would hold on to (42 MB against 5)
            held = pq.ParquetFile(stream, pre_buffer=False).read(columns=["item_id", "text"], use_threads=False)
            rows += zip(held.column("item_id").to_pylist(), held.column("text").to_pylist())
    return Items(rows, least)


def _tiler(files, least, coverage):
    def run(parts):
        items = _items(files, least)
        for b in parts:
            for held in slices(b, 4 << 20):
                flat, ends = hashed_words(held.column("text"))
                names, out = held.column("doc_id").to_pylist(), []
                for text, item in items.candidates(flat, ends).tolist():
                    words = items.words[item]
                    tiles = greedy_tiles(words, flat[ends[text] : ends[text + 1]], least)
                    covered = sum(t[2] for t in tiles)
                    if covered >= coverage * len(words):
                        out.append((names[text], items.ids[item], len(words), covered, len(tiles)))
                columns = list(zip(*out)) if out else [[]] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["doc_id", "item_id", "item_words", "covered_words", "n_tiles"])

    return run


def drop_contaminated(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """docs without those rows that cover an item; columns as they are, whatever their names.

    Rows that repeat a doc_id or have none are judged one by one; null and empty texts stay.
    """
    rows = identified(spark, docs)
    narrow = rows.select(F.col("_row").alias("doc_id"), F.col(f"_col{docs.columns.index('text')}").alias("text"))
    found = materialize(tile_coverage(spark, narrow, benchmark, **options).select(F.col("doc_id").alias("c_row")).distinct(), scratch(spark, "contaminated"))
    return rows.join(found, F.col("_row") == F.col("c_row"), "left_anti").drop("_row").toDF(*docs.columns)
