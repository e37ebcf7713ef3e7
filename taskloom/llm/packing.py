"""Best-fit packing by minimum bin slack.

Documents are cut into pieces of at most `capacity` tokens; a histogram of piece lengths (at most `capacity` rows,
whatever the corpus) is packed on the driver: each bin takes the longest length left and the subset of the other
available lengths that a bitset subset-sum program finds to leave the least slack. The combination is removed as
often as the counts allow at once, so the number of different combinations does not follow the corpus either. Pieces
then learn their place from their rank among the pieces of equal length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize, scratch, slices
from .encode import encoder as shared_encoder


def cut_pieces(docs: DataFrame, capacity: int, vocabulary: str, end_id: int, text_bytes: int = 4 << 20) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece of every document."""

    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = None
        for b in parts:
            for held in slices(b, text_bytes):
                encoder = encoder or shared_encoder(vocabulary)
                ids, sizes = encoder.encode_batch(held.column("text"))
                ends, rows = np.cumsum(sizes).tolist(), []
                for name, n, end in zip(held.column("doc_id").to_pylist(), sizes.tolist(), ends):
                    line = np.append(ids[end - n : end], np.uint32(end_id)).astype("<u4")
                    for k, start in enumerate(range(0, n + 1, capacity)):
                        piece = line[start : start + capacity]
                        rows.append((name, k, start, len(piece), zlib.crc32(piece.tobytes())))
                columns = list(zip(*rows))
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return rows.mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


def fullest(available: list[tuple[int, int]], room: int) -> list[tuple[int, int]]:
    """The (length, times) whose sum is the largest up to room; available: (length, count), longest first.

    Bit s of a bitset tells that some choice sums to s. Lengths are added one after another until the bit of room
    is set, so a full bin is met with the longest lengths that can make one.
    """
    mask, sums = (1 << (room + 1)) - 1, 1
    steps: list[tuple[int, int, int]] = []  # length, times, the bitset before
    for length, count in available:
        if length > room:
            continue
        count, times = min(count, room // length), 1
        while count > 0:
            times = min(times, count)
            steps.append((length, times, sums))
            sums |= (sums << (length * times)) & mask
            count -= times
            times *= 2
        if sums >> room & 1:
            break
    target, chosen = sums.bit_length() - 1, {}
    for length, times, before in reversed(steps):
        if not before >> target & 1:
            chosen[length] = chosen.get(length, 0) + times
            target -= length * times
    return sorted(chosen.items(), reverse=True)


def plan_bins(histogram: dict[int, int], capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """[(bins, [(length, times in each bin)])] that use up the histogram {length: pieces}."""
    left, plan = {k: v for k, v in histogram.items() if v > 0}, []
    while left:
        longest = max(left)
        rest = sorted(((k, v - (k == longest)) for k, v in left.items() if v > (k == longest)), reverse=True)
        chosen = dict(fullest(rest, capacity - longest))
        chosen[longest] = chosen.get(longest, 0) + 1
        bins = min(left[k] // v for k, v in chosen.items())
        plan.append((bins, sorted(chosen.items(), reverse=True)))
        for k, v in chosen.items():
            left[k] -= bins * v
            if not left[k]:
                del left[k]
    return plan


def slots(plan: list[tuple[int, list[tuple[int, int]]]]) -> dict[int, np.ndarray]:
    """For each length an array of (first rank, times in each bin, first bin, offset in the bin), ordered by rank."""
    table, first_bin, ranks = {}, 0, {}
    for bins, chosen in plan:
        offset = 0
        for length, times in chosen:
            table.setdefault(length, []).append((ranks.get(length, 0), times, first_bin, offset))
            ranks[length] = ranks.get(length, 0) + bins * times
            offset += length * times
        first_bin += bins
    return {k: np.array(v, np.int64) for k, v in table.items()}


def pack_documents(spark: SparkSession, docs: DataFrame, capacity: int = 2048, vocabulary: str = "word_bpe_49k.json", end_id: int = 0, salt_rows: int = 200_000) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece of docs (doc_id, text, any others).

    Null text counts as empty and gives one piece that is the end id alone. Rows that repeat a doc_id are packed one
    by one. An empty table gives no row. Texts of any length count whole. The pieces of one length are ranked in groups
    of about salt_rows, so a common length is as many groups as it has rows for; the driver holds one number a group.
    """
    pieces = materialize(cut_pieces(docs, capacity, vocabulary, end_id), scratch(spark, "pieces"))
    # at most capacity rows, whatever the corpus
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    groups = {length: -(-n // salt_rows) for length, n in histogram.items()}
    counted = F.broadcast(spark.createDataFrame(list(groups.items()), "s_length long, salts long"))
    salted = pieces.join(counted, F.col("length") == F.col("s_length")).withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), "salts").cast("int")).drop("s_length", "salts")
    # at most capacity rows and one more for each salt_rows pieces
    by_salt = {(r["length"], r["salt"]): r["count"] for r in salted.groupBy("length", "salt").count().collect()}
    before = {length: np.zeros(n, np.int64) for length, n in groups.items()}
    for length, n in groups.items():
        sizes = [by_salt.get((length, salt), 0) for salt in range(n - 1)]
        before[length][1:] = np.cumsum(sizes, dtype=np.int64)
    table = slots(plan_bins(histogram, capacity))
    ranked = salted.withColumn("rank", F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")) - 1)

    def place(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts:
            length, salt, rank = (b.column(c).to_numpy() for c in ("length", "salt", "rank"))
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            order = np.argsort(length, kind="stable")
            edges = np.flatnonzero(np.diff(length[order], prepend=-1, append=-1))
            for low, high in zip(edges[:-1], edges[1:]):
                own = order[low:high]
                size = int(length[own[0]])
                at = rank[own] + before[size][salt[own]]
                rows = table[size][np.searchsorted(table[size][:, 0], at, "right") - 1]
                inside = at - rows[:, 0]
                sequence[own] = rows[:, 2] + inside // rows[:, 1]
                offset[own] = rows[:, 3] + inside % rows[:, 1] * size
            kept = [b.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)], ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked.mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
