"""Phrase collocations: exact counts of all phrases of two to four frequent words, and their best-cut scores.

1. Texts are lower-cased (A-Z) and cut into pieces and words; every block of texts of one language is written as its
   distinct words, their counts, and a stream of places in that list.
2. Words that occur often enough in their language get ids by descending count; a block meets its own distinct words
   only, so a hot word crosses the network once for each block, not once for each occurrence.
3. At each place the ids of the next four words, zero beyond the piece or where a word is too rare, make a key of 16
   bytes (a frequent phrase holds frequent words only). Equal keys of a task are counted before the shuffle.
4. Keys are range-partitioned; a partition is radix-sorted by 16-bit digits and its runs of equal prefixes of two,
   three and four ids are the counts of the phrases. Runs that touch an end of a partition are summed across partitions.
5. Counts of the parts of each cut are looked up by joins; sums that may pass 64 bits are decimals.

Cases: a null text is empty, a null language is `und` (and shares its counts with a language of that name); repeated
rows count again; ties are ordered by a, then by the bytes of the phrase; an empty table gives an empty one; other
columns are not read; very long texts are whole within their block. Ids are of 32 bits; more frequent words are refused.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize, scratch, slices
from .words import byte_classes, cut_words

CLASSES = byte_classes(b" \t", b".,;:!?\n\x0b\x0c\r")
WORDS = 4
KEYS_HELD = 1 << 20
PARTITION_KEYS = 1_500_000


def text_blocks(spark: SparkSession, docs: DataFrame, size: int = 4 << 20) -> DataFrame:
    """block, lang, n_words, words (distinct), counts, stream: twice the word's place, plus 1 at the start of a piece."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, size):
                for lang in part.column("lang").unique().to_pylist():
                    texts = pc.ascii_lower(part.column("text").filter(pc.equal(part.column("lang"), lang)))
                    words, _, piece = cut_words(texts, CLASSES)
                    if not len(words):
                        continue
                    coded = words.dictionary_encode()
                    codes = coded.indices.to_numpy().astype(np.uint32)
                    first = np.ones(len(codes), np.uint32)
                    first[1:] = np.diff(piece) != 0
                    counts = np.bincount(codes, minlength=len(coded.dictionary)).astype(np.int64)
                    one = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang]), pa.array([len(codes)], pa.int64()), one(coded.dictionary.cast(pa.large_string()).cast(pa.string())), one(pa.array(counts)), pa.array([(codes * 2 + first).tobytes()], pa.binary())],
                        ["lang", "n_words", "words", "counts", "stream"],
                    )

    rows = docs.select("text", F.coalesce("lang", F.lit("und")).alias("lang")).where("text is not null")
    made = rows.mapInArrow(run, "lang string, n_words long, words array<string>, counts array<long>, stream binary")
    return materialize(made.withColumn("block", F.monotonically_increasing_id()), scratch(spark, "blocks"))


def frequent_words(spark: SparkSession, blocks: DataFrame, least: int) -> DataFrame:
    """lang, word, f, id: words with a count of `least` in their language; ids from 1 by descending count."""
    each = blocks.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("w")).select("lang", F.col("w.words").alias("word"), F.col("w.counts").alias("f"))
    found = each.groupBy("lang", "word").agg(F.sum("f").alias("f")).where(F.col("f") >= least)
    ranged = materialize(found, scratch(spark, "frequent")).repartitionByRange(F.desc("f"), "lang", "word").sortWithinPartitions(F.desc("f"), "lang", "word")
    placed = ranged.withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1))
    placed = materialize(placed, scratch(spark, "words"))
    before, offsets = 1, []
    for row in placed.groupBy("_part").count().orderBy("_part").collect():  # a row for each partition
        offsets.append((row["_part"], before))
        before += row["count"]
    if before > 1 << 32:
        raise ValueError("more frequent words than ids of 32 bits")
    table = spark.createDataFrame(offsets, "_part int, _before long")
    return placed.join(F.broadcast(table), "_part").select("lang", "word", "f", (F.col("_before") + F.col("_at")).alias("id"))


def radix_order(keys: np.ndarray) -> np.ndarray:
    """Order of rows of 32-bit numbers, by counting sorts of 16-bit digits from the last to the first; constant digits are skipped."""
    order = np.arange(len(keys))
    for column in reversed(range(keys.shape[1])):
        for shift in (0, 16):
            digit = (keys[:, column] >> shift).astype(np.uint16)
            if len(digit) and digit.min() != digit.max():
                order = order[np.argsort(digit[order], kind="stable")]
    return order


def counted(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and their summed counts."""
    order = radix_order(keys)
    keys, counts = keys[order], counts[order]
    first = np.ones(len(keys), bool)
    first[1:] = (keys[1:] != keys[:-1]).any(axis=1)
    at = np.flatnonzero(first)
    return keys[at], np.add.reduceat(counts, at) if len(at) else counts


def _packed(keys: np.ndarray) -> pa.Array:
    data = keys.astype(">u4").tobytes()
    width = 4 * keys.shape[1]
    return pa.Array.from_buffers(pa.binary(), len(keys), [None, pa.py_buffer((np.arange(len(keys) + 1) * width).astype(np.int32)), pa.py_buffer(data)])


def _unpacked(column: pa.Array) -> np.ndarray:
    at = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + 2]
    width = WORDS * 4
    data = np.frombuffer(column.buffers()[2], np.uint8)[at[0] : at[0] + width * len(column)]
    return data.view(">u4").reshape(len(column), WORDS).astype(np.uint32)


def windows(stream: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Rows of the next four ids at each place that starts a phrase of two words or more."""
    n = len(stream)
    out = np.zeros((n, WORDS), np.uint32)
    out[:, 0] = ids[stream >> 1]
    go = out[:, 0] > 0
    for k in range(1, WORDS):
        if n <= k:
            break
        go = go[: n - k] & (out[k:, 0] > 0) & (stream[k:] & 1 == 0)
        out[: n - k, k] = np.where(go, out[k:, 0], 0)
    return out[out[:, 1] > 0]


def id_windows(spark: SparkSession, blocks: DataFrame, words: DataFrame) -> DataFrame:
    """key (four ids, 16 bytes), n: the windows of all blocks, those of a task counted together."""
    of_block = blocks.select("block", "lang", F.posexplode("words").alias("place", "word")).join(words.select("lang", "word", "id"), ["lang", "word"])
    known = of_block.groupBy("block").agg(F.collect_list(F.struct("place", "id")).alias("known"))  # bounded by the block

    def run(batches):
        held, total = [], 0

        def flush():
            keys = np.concatenate(held)
            held.clear()
            keys, n = counted(keys, np.ones(len(keys), np.int64))
            for k in range(0, len(keys), 1 << 16):
                yield pa.RecordBatch.from_arrays([_packed(keys[k : k + (1 << 16)]), pa.array(n[k : k + (1 << 16)])], ["key", "n"])

        for batch in batches:
            for k in range(batch.num_rows):
                stream = np.frombuffer(batch.column("stream")[k].as_buffer(), np.uint32)
                pairs = batch.column("known")[k].values
                ids = np.zeros(int(batch.column("n_distinct")[k].as_py()), np.uint32)
                ids[pairs.field("place").to_numpy()] = pairs.field("id").to_numpy()
                held.append(windows(stream, ids))
                total += len(held[-1])
                if total >= KEYS_HELD:
                    yield from flush()
                    total = 0
        if held:
            yield from flush()

    joined = blocks.select("block", F.size("words").alias("n_distinct"), "stream").join(known, "block")
    return materialize(joined.select("n_distinct", "stream", "known").mapInArrow(run, "key binary, n long"), scratch(spark, "windows"))


def phrase_counts(spark: SparkSession, keys: DataFrame, least: int, partitions: int | None = None) -> DataFrame:
    """key (two to four ids), f: phrases that occur `least` times, f exact."""
    if partitions is None:
        partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), keys.count() // PARTITION_KEYS + 1)

    def run(batches):
        parts = [(_unpacked(b.column("key")), b.column("n").to_numpy()) for b in batches if b.num_rows]
        if not parts:
            return
        keys, n = counted(np.concatenate([k for k, _ in parts]), np.concatenate([c for _, c in parts]))
        del parts
        changed = keys[1:] != keys[:-1]
        new = np.ones(len(keys), bool)
        new[1:] = changed[:, 0]
        for width in range(2, WORDS + 1):
            new[1:] |= changed[:, width - 1]
            at = np.flatnonzero(new)
            f = np.add.reduceat(n, at)
            keep = f >= least
            keep[0] = keep[-1] = True  # the rest of these may lie in a neighbour
            keep &= keys[at, width - 1] > 0
            for part in np.array_split(np.flatnonzero(keep), int(keep.sum()) // (1 << 16) + 1):
                yield pa.RecordBatch.from_arrays([_packed(keys[at[part], :width]), pa.array(f[part])], ["key", "f"])

    found = keys.repartitionByRange(partitions, "key").mapInArrow(run, "key binary, f long")
    return found.groupBy("key").agg(F.sum("f").alias("f")).where(F.col("f") >= least)


def _part(key, first: int, n: int):
    return F.substring(key, 4 * first + 1, 4 * n)


def scored_phrases(spark: SparkSession, phrases: DataFrame, words: DataFrame) -> DataFrame:
    """key, a, l, r, score of phrases that no longer one mostly explains (80 % of their places)."""
    single = words.select(F.unhex(F.lpad(F.hex("id"), 8, "0")).alias("key"), "f")
    table = materialize(phrases.unionByName(single), scratch(spark, "phrases"))
    longer = table.select("key", F.col("f").alias("a"), (F.octet_length("key") / 4).cast("int").alias("m")).where("m > 1")
    cuts = F.array(*(F.when(F.col("m") > k, F.struct(F.lit(k).alias("cut"), F.lit(side).alias("side"), (_part(F.col("key"), 0, k) if side == "l" else F.substring(F.col("key"), 4 * k + 1, 4 * WORDS)).alias("part"))) for k in range(1, WORDS) for side in "lr"))
    asked = longer.select("key", "a", F.explode(F.array_compact(cuts)).alias("c")).select("key", "a", "c.*")
    told = asked.join(table.select(F.col("key").alias("part"), "f"), "part")
    one = lambda k, side: F.max(F.when((F.col("cut") == k) & (F.col("side") == side), F.col("f"))).alias(f"{side}{k}")
    parts = told.groupBy("key", "a").agg(*(one(k, side) for k in range(1, WORDS) for side in "lr"))
    whole = lambda column: F.col(column).cast("decimal(20,0)")
    score = lambda k: F.call_function("div", F.lit(2_000_000).cast("decimal(8,0)") * F.col("a").cast("decimal(19,0)"), whole(f"l{k}") + whole(f"r{k}"))
    choice = F.array_min(F.array_compact(F.array(*(F.when(F.col(f"l{k}").isNotNull(), F.struct(score(k).alias("score"), F.lit(k).alias("cut"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r"))) for k in range(1, WORDS)))))
    inner = F.array(*(F.when(F.col("m") >= at + n, _part(F.col("key"), at, n)) for n in range(2, WORDS) for at in range(WORDS - n + 1)))
    inner = F.filter(F.array_compact(inner), lambda s: F.octet_length(s) < 4 * F.col("m"))
    covers = longer.where("m > 2").select(F.explode(F.array_distinct(inner)).alias("key"), "a").groupBy("key").agg(F.max("a").alias("most"))
    kept = parts.select("key", "a", choice.alias("best")).join(covers, "key", "left").where("most is null or 100 * cast(most as decimal(20,0)) < 80 * cast(a as decimal(20,0))")
    return kept.select("key", "a", "best.l", "best.r", "best.score")


def collocations(spark: SparkSession, docs: DataFrame, least: int = 30, top: int = 2000, salts: int = 64) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first `top` phrases of each language by score, a, phrase."""
    blocks = text_blocks(spark, docs)
    words = materialize(frequent_words(spark, blocks, least), scratch(spark, "dictionary"))
    counts = phrase_counts(spark, id_windows(spark, blocks, words), least)
    scored = materialize(scored_phrases(spark, counts, words), scratch(spark, "scored"))
    m = F.octet_length("key") / 4
    ids = F.transform(F.sequence(F.lit(1), m.cast("int")), lambda k: F.conv(F.hex(F.substring(F.col("key"), 4 * k - 3, F.lit(4))), 16, 10).cast("long"))
    spelt = scored.select("key", F.posexplode(ids).alias("place", "id")).join(words.select("id", "lang", "word"), "id")
    spelt = spelt.groupBy("key").agg(F.first("lang").alias("lang"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "word"))), lambda x: x["word"]), " ").alias("phrase"))
    rows = scored.join(spelt, "key").withColumn("_salt", F.pmod(F.xxhash64("key"), F.lit(salts)))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    best = rows.withColumn("_at", F.row_number().over(Window.partitionBy("lang", "_salt").orderBy(*order))).where(F.col("_at") <= top)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    totals = blocks.groupBy("lang").agg(F.sum("n_words").alias("n"))
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
