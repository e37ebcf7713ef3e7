"""Removal of long repeated strings by suffix arrays, for corpora far larger than one machine.

A window is a string of `length` bytes. Each window belongs to the anchor it contains: the gram of `gram` bytes with
the smallest hash. Equal windows contain equal anchors at equal places, so windows of different anchors never have to
meet, and an anchor that occurs once rules out all its windows. Those whose anchor repeats are cut out with the
windows around them, dealt to shards by anchor, and each shard sorts its suffixes by external induced sorting
(induced.py); common-prefix values of at least `length` mark the repeated windows.

Exact copies of a text or of a cut-out are represented once. Anchors that are frequent in the whole corpus are not
shuffled to be counted, and their cut-outs are dealt by most of the window's bytes instead of by the anchor.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import batches, materialize, scratch
from .induced import repeated_positions
from .jaccard import mix

U = np.uint64
PLACE_BITS = 28  # of a batch's positions; the other bits of an anchor's order are its hash


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A 64-bit hash of the `gram` bytes (a power of two, at least 8) at each position; 0 where fewer are left."""
    n = len(data) - gram + 1
    if n <= 0:
        return np.zeros(len(data), U)
    words = np.ndarray((len(data) - 7,), "<u8", np.ascontiguousarray(data).data, 0, (1,)).astype(U)
    words *= U(0x9E3779B97F4A7C15)
    words ^= words >> U(29)
    reach, odd = 8, 0xD6E8FEB86659FD93
    while reach < gram:
        m = len(words) - reach
        words = words[:m] * U(odd) + words[reach:]
        words ^= words >> U(32)
        odd = odd * 0x2545F4914F6CDD1D % 2**64 | 1
        reach *= 2
    out = np.zeros(len(data), U)
    out[:n] = mix(words[:n])
    return out


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    reach = 1
    while reach * 2 <= width:
        values = np.minimum(values[:-reach], values[reach:])
        reach *= 2
    return np.minimum(values[: len(values) - (width - reach)], values[width - reach :]) if width > reach else values


def find_anchors(texts: list[bytes], length: int, gram: int):
    """(text number, anchor place, first window, last window, anchor hash) of every run of windows with one anchor.

    Places count from the beginning of the text.
    """
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    begins = np.cumsum(sizes) - sizes
    data = np.frombuffer(b"".join(texts), np.uint8)
    if len(data) > 1 << PLACE_BITS:
        raise ValueError(f"a batch of {len(data)} bytes of text; places have {PLACE_BITS} bits")
    empty = np.empty(0, np.int64)
    if len(data) < length:
        return empty, empty, empty, empty, np.empty(0, U)
    hashes = gram_hashes(data, gram)
    order = (hashes >> U(PLACE_BITS) << U(PLACE_BITS)) | np.arange(len(data), dtype=U)
    place = (sliding_minimum(order[: len(data) - gram + 1], length - gram + 1) & U((1 << PLACE_BITS) - 1)).astype(np.int64)
    windows = np.maximum(sizes - length + 1, 0)
    some = np.flatnonzero(windows)
    if not len(some):
        return empty, empty, empty, empty, np.empty(0, U)
    starts = np.repeat(begins[some] - (np.cumsum(windows[some]) - windows[some]), windows[some]) + np.arange(int(windows.sum()))
    owner = np.repeat(some, windows[some])
    own = place[starts]
    first = np.flatnonzero(np.r_[True, (own[1:] != own[:-1]) | (owner[1:] != owner[:-1])])
    last = np.r_[first[1:], len(own)] - 1
    who = owner[first]
    return who, own[first] - begins[who], starts[first] - begins[who], starts[last] - begins[who], hashes[own[first]]


def _rows(parts: Iterator[pa.RecordBatch], names: tuple[str, ...], size: int = 2 << 20):
    """Lists of rows (text last) of about so many bytes; a text too long for one batch's positions is refused."""
    for b in parts:
        for held in batches(zip(*(b.column(c).to_pylist() for c in names)), size, lambda r: len(r[-1]) + 64):
            yield held


def anchor_entries(texts: DataFrame, length: int, gram: int, buckets: int) -> DataFrame:
    """bucket, ids (two longs a text), owner, run, key: anchors of a batch of texts for one bucket; often: keys the batch has often."""

    def run(parts):
        seen: set[tuple[int, int]] = set()
        for held in _rows(parts, ("t1", "t2", "text")):
            fresh = []
            for t1, t2, text in held:
                if (t1, t2) not in seen:
                    if len(seen) < 300_000:
                        seen.add((t1, t2))
                    fresh.append((t1, t2, text))
            if not fresh:
                continue
            who, _, _, _, key = find_anchors([r[2] for r in fresh], length, gram)
            if not len(who):
                continue
            number = np.arange(len(who)) - np.searchsorted(who, who)
            ids = np.array([r[:2] for r in fresh], np.int64)
            keys, times = np.unique(key, return_counts=True)
            often = keys[times >= max(4, len(fresh) / 200)].view(np.int64).tolist()
            bucket = ((key >> U(20)) % U(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            who, number, key, bucket = who[order], number[order].astype(np.uint32), key[order], bucket[order]
            edges = np.flatnonzero(np.diff(bucket, prepend=-1, append=-1))
            rows = []
            for a, b in zip(edges[:-1], edges[1:]):
                own, local = np.unique(who[a:b], return_inverse=True)
                rows.append((int(bucket[a]), ids[own].tobytes(), local.astype(np.uint32).tobytes(), number[a:b].tobytes(), key[a:b].tobytes(), often if a == 0 else None))
            kinds = (pa.int32(), *[pa.binary()] * 4, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["bucket", "ids", "owner", "run", "key", "often"])

    return texts.mapInArrow(run, "bucket int, ids binary, owner binary, run binary, key binary, often array<long>")


def _entries(b: pa.RecordBatch):
    for bucket, ids, owner, run, key in zip(*(b.column(c).to_pylist() for c in ("bucket", "ids", "owner", "run", "key"))):
        yield bucket, np.frombuffer(ids, np.int64).reshape(-1, 2), np.frombuffer(owner, np.uint32), np.frombuffer(run, np.uint32), np.frombuffer(key, U)


def _by_text(ids: np.ndarray, run: np.ndarray) -> pa.RecordBatch:
    """One row for each text: its run numbers."""
    order = np.lexsort((run, ids[:, 1], ids[:, 0]))
    ids, run = ids[order], run[order]
    edges = np.flatnonzero(np.r_[True, (ids[1:] != ids[:-1]).any(axis=1), True]) if len(ids) else np.zeros(1, np.int64)
    rows = [run[a:b].astype(np.int32).tolist() for a, b in zip(edges[:-1], edges[1:])]
    heads = ids[edges[:-1]]
    return pa.RecordBatch.from_arrays([pa.array(heads[:, 0]), pa.array(heads[:, 1]), pa.array(rows, pa.list_(pa.int32()))], ["t1", "t2", "runs"])


def repeated_runs(entries: DataFrame, frequent: np.ndarray, buckets: int) -> DataFrame:
    """t1, t2, runs: numbers of a text's runs whose anchor occurs at least twice (several rows a text)."""

    def is_frequent(key):
        at = np.searchsorted(frequent, key)
        at[at == len(frequent)] = 0
        return frequent[at] == key if len(frequent) else np.zeros(len(key), bool)

    def known(parts):
        for b in parts:
            for _, ids, owner, run, key in _entries(b):
                hit = is_frequent(key)
                if hit.any():
                    yield _by_text(ids[owner[hit]], run[hit])

    def count(parts):
        held: dict[int, list] = {}
        for b in parts:
            for bucket, ids, owner, run, key in _entries(b):
                rest = ~is_frequent(key)
                held.setdefault(bucket, []).append((ids[owner[rest]], run[rest], key[rest]))
        for bucket in sorted(held):
            ids, run, key = (np.concatenate(x) for x in zip(*held.pop(bucket)))
            order = np.argsort(key, kind="stable")
            same = key[order][1:] == key[order][:-1]
            hit = np.zeros(len(key), bool)
            hit[order[1:][same]] = hit[order[:-1][same]] = True
            # copies of a text from several tasks are one text
            ids, run, key = ids[hit], run[hit], key[hit]
            order = np.lexsort((run, ids[:, 1], ids[:, 0], key))
            ids, run, key = ids[order], run[order], key[order]
            if len(key):
                new = np.r_[True, (key[1:] != key[:-1]) | (run[1:] != run[:-1]) | (ids[1:] != ids[:-1]).any(axis=1)]
                ids, run, key = ids[new], run[new], key[new]
                _, which, times = np.unique(key, return_inverse=True, return_counts=True)
                good = (times > 1)[which]
                if good.any():
                    yield _by_text(ids[good], run[good])

    schema = "t1 long, t2 long, runs array<int>"
    cold = entries.select("bucket", "ids", "owner", "run", "key").repartition(buckets, "bucket").mapInArrow(count, schema)
    return cold.unionAll(entries.select("bucket", "ids", "owner", "run", "key").mapInArrow(known, schema)) if len(frequent) else cold


def cut_outs(chosen: DataFrame, length: int, gram: int, frequent: np.ndarray, classes: int = 16) -> DataFrame:
    """key, sid, t1, t2, start, windows, piece: each repeated run, or part of a frequent one; piece only the first time in a task."""

    def run(parts):
        seen: set[tuple[int, int]] = set()
        for held in _rows(parts, ("t1", "t2", "runs", "text")):
            texts = [r[3] for r in held]
            who, place, first, last, key = find_anchors(texts, length, gram)
            number = np.arange(len(who)) - np.searchsorted(who, who)
            wanted = [set(x for part in r[2] for x in part) for r in held]
            pick = np.fromiter((n in wanted[w] for w, n in zip(who.tolist(), number.tolist())), bool, len(who))
            who, place, first, last, key = (x[pick] for x in (who, place, first, last, key))
            at = np.searchsorted(frequent, key)
            at[at == len(frequent)] = 0
            hot = (frequent[at] == key).tolist() if len(frequent) else [False] * len(key)
            rows = []
            for w, a, s, e, k, h in zip(who.tolist(), place.tolist(), first.tolist(), last.tolist(), key.view(np.int64).tolist(), hot):
                text = texts[w]
                if not h:
                    spans = [(k, s, e)]
                else:  # windows of one class of distances to the anchor share all but `classes` - 1 bytes
                    spans = []
                    for c in range((a - e) // classes, (a - s) // classes + 1):
                        low, high = max(s, a - classes * c - classes + 1), min(e, a - classes * c)
                        if low <= high:
                            shared = text[a - classes * c : a - classes * c - classes + 1 + length]
                            spans.append((int.from_bytes(hashlib.blake2b(shared, digest_size=8, salt=c.to_bytes(4, "little")).digest(), "little", signed=True), low, high))
                for k2, s2, e2 in spans:
                    piece = text[s2 : e2 + length]
                    sid = int.from_bytes(hashlib.blake2b(piece, digest_size=8).digest(), "little", signed=True)
                    new = (k2, sid) not in seen
                    if new and len(seen) < 300_000:
                        seen.add((k2, sid))
                    rows.append((k2, sid, held[w][0], held[w][1], s2, e2 - s2 + 1, piece if new else None))
            kinds = (*[pa.int64()] * 4, pa.int64(), pa.int32(), pa.binary())
            columns = list(zip(*rows)) if rows else [[]] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["key", "sid", "t1", "t2", "start", "windows", "piece"])

    return chosen.mapInArrow(run, "key long, sid long, t1 long, t2 long, start long, windows int, piece binary")


def sort_shards(pieces: DataFrame, length: int, shards: int, spill: str | None, memory: int) -> DataFrame:
    """key, sid, hits: first and last numbers (32 bits each) of the runs of a piece's windows that another piece has."""

    def run(parts):
        import os

        groups: dict[int, dict[int, dict[int, bytes]]] = {}
        for b in parts:
            for shard, key, sid, piece in zip(*(b.column(c).to_pylist() for c in ("shard", "key", "sid", "piece"))):
                groups.setdefault(shard, {}).setdefault(key, {})[sid] = piece
        if spill:
            os.makedirs(spill, exist_ok=True)
        for shard in sorted(groups):
            alive = [(k, s, p) for k, own in groups.pop(shard).items() if len(own) > 1 for s, p in own.items()]
            if not alive:
                continue
            text = np.frombuffer(b"\xff".join(p for _, _, p in alive), np.uint8)  # a byte that UTF-8 never has
            sizes = np.fromiter((len(p) for _, _, p in alive), np.int64, len(alive))
            ends = np.cumsum(sizes + 1) - 1
            found = repeated_positions(text, length, folder=spill, memory=memory)
            begins = ends - sizes
            rows = []
            for (key, sid, piece), a in zip(alive, begins.tolist()):
                hit = np.flatnonzero(found[a : a + len(piece) - length + 1])
                if len(hit):
                    cut = np.flatnonzero(np.diff(hit) > 1)
                    rows.append((key, sid, np.stack([hit[np.r_[0, cut + 1]], hit[np.r_[cut, len(hit) - 1]]]).astype("<i4").tobytes()))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), (pa.int64(), pa.int64(), pa.binary()))], ["key", "sid", "hits"])

    return pieces.repartition(shards, "shard").mapInArrow(run, "key long, sid long, hits binary")


def remove_repeats(spark: SparkSession, docs: DataFrame, length: int = 200, gram: int = 64, shard_bytes: int = 4 << 20, memory: int = 1 << 27, small: int = 1_000_000) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row of docs (doc_id, text, any others).

    A byte goes if a string of `length` bytes around it starts anywhere else as well, in the same text or another.
    Null texts count as empty; rows that repeat a doc_id, and equal texts, are texts like others (so both go). An empty
    table gives no row.
    """
    if not 8 <= gram <= length or gram & (gram - 1):
        raise ValueError("gram must be a power of two from 8 to length")
    data = F.encode(F.coalesce(F.col("text").cast("string"), F.lit("")), "UTF-8")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), data.alias("text"))
    rows = rows.withColumns({"t1": F.xxhash64("text"), "t2": F.xxhash64(F.lit(7), "text")})
    facts = materialize(rows.select("doc_id", "t1", "t2", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("sha")), scratch(spark, "texts"))
    total = facts.agg(F.sum("n_bytes")).first()[0] or 0
    long_ = rows.where(F.octet_length("text") >= length).select("t1", "t2", "text")
    buckets = int(max(8, total // (32 << 20) + 1))
    entries = materialize(anchor_entries(long_, length, gram, buckets), scratch(spark, "anchors"))
    # anchors of a two-hundredth of a batch's texts, in a twentieth of all batches: their number has a bound that no corpus moves
    marked = entries.where("often is not null").select("often")
    least = max(2, marked.count() // 20)
    frequent = np.sort(np.array([r.h for r in marked.select(F.explode("often").alias("h")).groupBy("h").count().where(F.col("count") >= least).select("h").collect()], np.int64).view(U))
    runs = repeated_runs(entries, frequent, buckets).groupBy("t1", "t2").agg(F.collect_list("runs").alias("runs"))
    runs = materialize(runs, scratch(spark, "runs"))
    ids = runs.select("t1", "t2")
    wanted = long_.join(F.broadcast(ids) if runs.count() <= small else ids, ["t1", "t2"], "left_semi").dropDuplicates(["t1", "t2"])
    chosen = materialize(wanted.join(runs, ["t1", "t2"]).select("t1", "t2", "runs", "text"), scratch(spark, "chosen"))
    cuts = materialize(cut_outs(chosen, length, gram, frequent), scratch(spark, "cuts"))
    size = cuts.agg(F.sum(F.octet_length("piece"))).first()[0] or 0
    shards = int(max(4, size // shard_bytes + 1))
    pieces = cuts.where("piece is not null").select(F.pmod("key", F.lit(shards)).cast("int").alias("shard"), "key", "sid", "piece")
    where = urlparse(scratch(spark, "spill"))
    spill = where.path if where.scheme in ("", "file") else None
    hits = materialize(sort_shards(pieces, length, shards, spill, memory), scratch(spark, "hits"))
    several = cuts.groupBy("key", "sid").agg(F.count("*").alias("times")).where("times > 1").select("key", "sid")
    state = several.withColumn("all", F.lit(True)).join(hits, ["key", "sid"], "full").select(F.col("key").alias("k"), F.col("sid").alias("s"), "all", "hits")
    places = cuts.select("key", "sid", "t1", "t2", "start", "windows").join(state, (F.col("key") == F.col("k")) & (F.col("sid") == F.col("s"))).select("t1", "t2", "start", "windows", F.coalesce("all", F.lit(False)).alias("all"), "hits")
    spans = places.groupBy("t1", "t2").agg(F.collect_list(F.struct("start", "windows", "all", "hits")).alias("spans"))

    def remove(parts):
        for b in parts:
            out = []
            for t1, t2, found, text in zip(*(b.column(c).to_pylist() for c in ("t1", "t2", "spans", "text"))):
                edge = np.zeros(len(text) + 1, np.int64)
                for s in found:
                    if s["all"]:
                        edge[s["start"]] += 1
                        edge[s["start"] + s["windows"] - 1 + length] -= 1
                    else:
                        low, high = np.frombuffer(s["hits"], "<i4").reshape(2, -1)
                        np.add.at(edge, s["start"] + low, 1)
                        np.add.at(edge, s["start"] + high + length, -1)
                gone = np.cumsum(edge[:-1]) > 0
                kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
                out.append((t1, t2, int(gone.sum()), int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum()), hashlib.sha256(kept).hexdigest(), kept))
            columns = list(zip(*out)) if out else [[]] * 6
            kinds = (*[pa.int64()] * 4, pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["t1", "t2", "n_removed", "n_spans", "kept_sha256", "kept"])

    done = chosen.select("t1", "t2", "text").join(spans, ["t1", "t2"]).mapInArrow(remove, "t1 long, t2 long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    copies = facts.groupBy("t1", "t2").agg(F.count("*").alias("copies"))
    per_text = copies.join(done.drop("kept"), ["t1", "t2"], "left").select(F.col("t1").alias("a"), F.col("t2").alias("b"), "copies", "n_removed", "n_spans", "kept_sha256")
    full = facts.join(per_text, (F.col("t1") == F.col("a")) & (F.col("t2") == F.col("b")))
    twice = (F.col("copies") > 1) & (F.col("n_bytes") >= length)
    return full.select(
        "doc_id", "n_bytes", F.when(twice, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(twice, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(twice, F.sha2(F.lit("").cast("binary"), 256)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
    )
