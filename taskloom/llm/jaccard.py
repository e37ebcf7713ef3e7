"""Exact n-gram Jaccard self-join by universe partition and pigeonhole.

A document is its set of distinct word n-grams, as 64-bit hashes. Sets of J >= p / q differ in at most
H = (|R| + |S|) (q - p) / (q + p) elements. The universe is hashed into the segments of a size band; if S has at least
H + 1 non-empty segments, one of any H + 1 of them is equal in R, so R is indexed under the hash of each segment and S
asks for H + 1 of its own. S allots them by cost: segments with most elements that are not frequent in the corpus go
first, as they have the shortest lists. Where H + 1 non-empty segments are not to be had (small sets, by chance), the
band also indexes one-deletion neighbourhoods and its sets ask for some segments with one deletion, each of which
counts as two. Candidates are verified on whole sets.

Equal sets are collapsed first, by two 64-bit hashes. Entries travel packed: each map task sends one row per batch and
bucket of signatures. The members of a signature go on as one cluster under the member of the least key; signatures
that share most members so have the same hub, and a pair stands in few clusters, however many signatures it shares.
Each member is compared with its hub; only what then is not connected inside a cluster is compared pair by pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, identified, materialize, release, scratch, slices
from .components import connected_components, link_in_clusters
from .words import hashed_words

U = np.uint64
WORDS = 8  # of parities that a candidate carries
SMALL = 64  # bands of sets up to this size index deletions from the start


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finalizer of MurmurHash3; fixed values)."""
    x = x ^ (x >> U(33))
    x = x * U(0xFF51AFD7ED558CCD)
    x = x ^ (x >> U(33))
    x = x * U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U(33))


class Shingler:
    """Sorted distinct 64-bit hashes of the word n-grams of texts; fewer words give one hash of them all."""

    def __init__(self, n: int = 5):
        self.n = n
        self.odd = np.random.default_rng(11).integers(1, 2**63, n, dtype=np.uint64) * U(2) + U(1)

    def _mixed(self, words: np.ndarray, n: int) -> np.ndarray:
        total = np.full(max(0, len(words) - n + 1), U(n * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
        for k in range(n):
            total += words[k : k + len(total)] * self.odd[k]
        return mix(total)

    def __call__(self, texts: pa.Array | list[str | None]) -> list[np.ndarray]:
        flat, ends = hashed_words(pa.array(texts, pa.string()) if isinstance(texts, list) else texts)
        grams, out = self._mixed(flat, self.n), []
        for a, b in zip(ends[:-1].tolist(), ends[1:].tolist()):
            if b - a >= self.n:
                out.append(np.unique(grams[a : b - self.n + 1]))
            else:
                out.append(self._mixed(flat[a:b], b - a) if b > a else flat[:0])
        return out


class Scheme:
    """Size bands [2^k, 2^(k+1)) and what a set of a given size needs in each, for J >= p / q."""

    def __init__(self, p: int, q: int):
        self.p, self.q = p, q

    def band(self, size: np.ndarray) -> np.ndarray:
        return np.frexp(size.astype(np.float64))[1].astype(np.int64) - 1

    def segments(self, band: np.ndarray) -> np.ndarray:
        """Segments of a band: enough for H + 1 non-empty ones, with room for chance."""
        high = 2.0 ** (band + 1)
        share = 2 * (self.q - self.p) / (self.q + self.p)
        return np.ceil(high * (1.26 * share) + 3 * np.sqrt(high) + 1).astype(np.int64)

    def largest(self, size: np.ndarray) -> np.ndarray:
        """The largest partner of a set that asks."""
        return size * self.q // self.p

    def need(self, size: np.ndarray, band: np.ndarray) -> np.ndarray:
        """H + 1 for a set that asks in a band of sets at least as large."""
        partner = np.minimum(self.largest(size), 2 ** (band + 1) - 1)
        return (size + partner) * (self.q - self.p) // (self.q + self.p) + 1


def segment(sets: list[np.ndarray], bands: np.ndarray, scheme: Scheme, frequent: np.ndarray):
    """For sets as seen in the given bands: per non-empty segment the set, the segment, its sum, elements, rare elements."""
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    m = scheme.segments(bands)
    base = np.cumsum(m) - m
    owner = np.repeat(np.arange(len(sets)), sizes)
    flat = np.concatenate(sets) if len(sets) else np.empty(0, U)
    at = base[owner] + (mix(flat ^ (bands[owner].astype(U) * U(0x9E3779B97F4A7C15))) % m[owner].astype(U)).astype(np.int64)
    total = int(m.sum())
    count = np.bincount(at, minlength=total)
    rare = count
    if len(frequent):
        k = np.searchsorted(frequent, flat)
        k[k == len(frequent)] = 0
        rare = np.bincount(at[frequent[k] != flat], minlength=total)
    sums = np.zeros(total, U)
    np.add.at(sums, at, mix(flat + U(0x632BE59BD9B4E019)))
    full = np.flatnonzero(count)
    who = np.repeat(np.arange(len(sets)), m)[full]
    return who, full - base[who], sums[full], count[full], rare[full], (flat, owner, at, sums, base, m)


def signature(band: np.ndarray, seg: np.ndarray, sums: np.ndarray) -> np.ndarray:
    return mix(sums ^ mix(band.astype(U) << U(40) ^ seg.astype(U)))


def emit(sets: list[np.ndarray], scheme: Scheme, frequent: np.ndarray, deep: int):
    """(set number, signature, flags) of all entries; flag 1: indexed, 2: asks, 4: made by a deletion.

    deep: bit set of the bands that index deletions and empty segments.
    """
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    own = scheme.band(sizes)
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    most = scheme.band(scheme.largest(sizes))
    for step in range(int((most - own).max(initial=0)) + 1):
        chosen = np.flatnonzero(most >= own + step)
        part, band = [sets[k] for k in chosen], own[chosen] + step
        who, seg, sums, count, rare, detail = segment(part, band, scheme, frequent)
        sig = signature(band[who], seg, sums)
        need = scheme.need(sizes[chosen], band)
        full = np.bincount(who, minlength=len(part))
        order = np.argsort(who * 4096 + (63 - np.minimum(rare, 63)) * 64 + (63 - np.minimum(count, 63)), kind="stable")
        rank = np.empty(len(who), np.int64)
        rank[order] = np.arange(len(who)) - (np.cumsum(full) - full)[who[order]]
        asks = rank < need[who]
        flags = np.where(asks, 2, 0) + (1 if step == 0 else 0)
        used = flags > 0
        out.append((chosen[who[used]], sig[used], flags[used]))
        if deep:
            out += _neighbours(chosen, band, step == 0, need, full, who, seg, sums, rank, detail, deep)
    return [np.concatenate(x) for x in zip(*out)] if out else [np.empty(0, np.int64), np.empty(0, U), np.empty(0, np.int64)]


def _neighbours(chosen, band, index, need, full, who, seg, sums, rank, detail, deep):
    """Entries of one-deletion neighbourhoods and of empty segments, in the bands that have them."""
    flat, owner, at, all_sums, base, m = detail
    is_deep = (deep >> np.minimum(band, 62) & 1).astype(bool)
    extra = np.where(is_deep, np.maximum(need - full, 0), 0)  # so many segments ask with one deletion
    widened = np.minimum(extra, full)
    still = extra - widened
    rank_of = np.full(int(m.sum()), 1 << 40, np.int64)
    rank_of[base[who] + seg] = rank
    asks = rank_of[at] < widened[owner]
    keep = asks | (is_deep[owner] if index else False)
    less = all_sums[at] - mix(flat + U(0x632BE59BD9B4E019))
    sig = signature(band[owner], at - base[owner], less)
    rows = [(chosen[owner[keep]], sig[keep], (np.where(asks, 2, 0) + 4 + (1 if index else 0))[keep])]
    # empty segments: indexed in deep bands; asked for, at last, where even doubled segments do not suffice
    hollow = np.ones(int(m.sum()), bool)
    hollow[at] = False
    spot = np.flatnonzero(hollow & np.repeat(is_deep, m))
    if len(spot):
        of = np.repeat(np.arange(len(m)), m)[spot]
        nth = np.arange(len(spot)) - np.searchsorted(of, of)
        ask = nth < still[of]
        keep = ask if not index else np.ones(len(spot), bool)
        sig = signature(band[of], spot - base[of], np.zeros(len(spot), U))
        rows.append((chosen[of[keep]], sig[keep], (np.where(ask, 2, 0) + (1 if index else 0))[keep]))
    return rows


def short_of_segments(sets: list[np.ndarray], scheme: Scheme) -> int:
    """Bit set of the bands in which some set has fewer non-empty segments than it must ask for."""
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    own, found = scheme.band(sizes), 0
    most = scheme.band(scheme.largest(sizes))
    for step in range(int((most - own).max(initial=0)) + 1):
        chosen = np.flatnonzero(most >= own + step)
        band = own[chosen] + step
        m = scheme.segments(band)
        base = np.cumsum(m) - m
        owner = np.repeat(np.arange(len(chosen)), sizes[chosen])
        flat = np.concatenate([sets[k] for k in chosen])
        hit = np.zeros(int(m.sum()), bool)
        hit[base[owner] + (mix(flat ^ (band[owner].astype(U) * U(0x9E3779B97F4A7C15))) % m[owner].astype(U)).astype(np.int64)] = True
        full = np.add.reduceat(hit, base) if len(base) else base
        for b in np.unique(band[full < scheme.need(sizes[chosen], band)]).tolist():
            found |= 1 << min(b, 62)
    return found


def identity(s: np.ndarray) -> tuple[int, int]:
    """Two independent 64-bit hashes of a set; (0, 0) of the empty one."""
    return (int(mix(s).sum(dtype=U)), int(np.bitwise_xor.reduce(mix(s + U(1))))) if len(s) else (0, 0)


def rekeyed(key: int, check: int) -> int:
    """A 64-bit hash of both hashes of a set."""
    return int(mix(mix(np.array([key & (1 << 64) - 1], U)) ^ np.array([check & (1 << 64) - 1], U))[0])


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def key_of(s: np.ndarray, twins: frozenset[int]) -> int:
    """The key of a set: its first hash, or one of both where different sets (twins) share the first."""
    key, check = identity(s)
    return rekeyed(key, check) if key in twins else key


def _sets(parts: Iterator[pa.RecordBatch], n: int, size: int = 1 << 20):
    """(doc_ids, sets) of a few texts after another."""
    shingler = Shingler(n)
    for b in parts:
        for held in slices(b, size):
            yield held.column("doc_id").to_pylist(), shingler(held.column("text"))


def describe(docs: DataFrame, n: int, scheme: Scheme) -> DataFrame:
    """doc_id, n_shingles, key, check (two hashes of the set), short (bit set of bands), often (frequent n-grams of the batch)."""

    def run(parts):
        for names, sets in _sets(parts, n, 3 << 20):
            keys, checks = zip(*map(identity, sets))
            short = short_of_segments([s for s in sets if len(s)], scheme)
            cells = parities(sets)
            hashes, times = np.unique(np.concatenate(sets), return_counts=True)
            often = hashes[times >= max(3, len(sets) / 300)]
            first = [(short, often.view(np.int64).tolist())] + [(0, None)] * (len(sets) - 1)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(names, pa.int64()), pa.array(list(map(len, sets)), pa.int64()), pa.array(np.array(keys, U).view(np.int64)), pa.array(np.array(checks, U).view(np.int64)),
                    pa.array([x for x, _ in first], pa.int64()), pa.array([x for _, x in first], pa.list_(pa.int64())),
                    *(pa.array(np.ascontiguousarray(cells[:, k])) for k in range(WORDS)),
                ],
                ["doc_id", "n_shingles", "key", "check", "short", "often", *(f"c{k}" for k in range(WORDS))],
            )

    return docs.mapInArrow(run, "doc_id long, n_shingles long, key long, check long, short long, often array<long>" + "".join(f", c{k} long" for k in range(WORDS)))


def index_entries(docs: DataFrame, n: int, scheme: Scheme, frequent: np.ndarray, deep: int, buckets: int, twins: frozenset[int] = frozenset()) -> DataFrame:
    """bucket, keys, owner, sig, flags: the packed entries of one batch of documents for one bucket."""

    def pack(waiting):
        shift = np.cumsum([0, *(len(w[0]) for w in waiting)])
        keys, owner, sig, flags = (np.concatenate(x) for x in zip(*((k, o + d, s, f) for (k, o, s, f), d in zip(waiting, shift))))
        bucket = (sig >> U(32)) % U(buckets)
        order = np.argsort(bucket.astype(np.uint16 if buckets <= 65536 else np.uint32), kind="stable")
        owner, sig, flags, bucket = owner[order].astype(np.uint32), (sig[order] & U(0xFFFFFFFF)).astype(np.uint32), flags[order], bucket[order]
        edges = np.flatnonzero(np.diff(bucket.astype(np.int64), prepend=-1, append=-1))
        rows = []
        for low, high in zip(edges[:-1], edges[1:]):
            own, local = np.unique(owner[low:high], return_inverse=True)
            wide = np.uint16 if len(own) <= 65536 else np.uint32
            rows.append((int(bucket[low]), keys[own].tobytes(), local.astype(wide).tobytes(), sig[low:high].tobytes(), flags[low:high].tobytes()))
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), (pa.int32(), *[pa.binary()] * 4))], ["bucket", "keys", "owner", "sig", "flags"])

    def run(parts):
        seen, waiting, pending = set(), [], 0
        for _, found in _sets(parts, n):
            sets, keys = [], []
            for s in found:
                key = key_of(s, twins)
                if len(s) and key not in seen:
                    if len(seen) < 1_000_000:
                        seen.add(key)
                    sets.append(s)
                    keys.append(key)
            if sets:
                owner, sig, flags = emit(sets, scheme, frequent, deep)
                waiting.append((np.array(keys, U), owner, sig, flags.astype(np.uint8)))
                pending += len(sig)
            if pending >= 500_000:
                yield pack(waiting)
                waiting, pending = [], 0
        if waiting:
            yield pack(waiting)

    return docs.mapInArrow(run, "bucket int, keys binary, owner binary, sig binary, flags binary")


def meet(entries: DataFrame, buckets: int) -> DataFrame:
    """hub, member: the other sets under each signature that at least two different sets have, and the one of the least key."""

    def run(parts):
        held: dict[int, list] = {}
        for b in parts:
            for bucket, keys, owner, sig, flags in zip(*(b.column(c).to_pylist() for c in ("bucket", "keys", "owner", "sig", "flags"))):
                local = np.frombuffer(owner, np.uint16 if len(owner) == 2 * len(flags) else np.uint32)
                held.setdefault(bucket, []).append((np.frombuffer(keys, U), local, np.frombuffer(sig, np.uint32), np.frombuffer(flags, np.uint8)))
        for bucket in sorted(held):
            rows = held.pop(bucket)
            sig, flags = np.concatenate([r[2] for r in rows]), np.concatenate([r[3] for r in rows])
            shift = np.cumsum([0, *(len(r[0]) for r in rows)])
            local = np.concatenate([r[1].astype(np.int64) + s for r, s in zip(rows, shift)])
            keys = np.concatenate([r[0] for r in rows])
            del rows
            order = np.argsort(sig, kind="stable")
            sig, flags, local = sig[order], flags[order], local[order]
            same = np.zeros(len(sig), bool)
            same[1:] = sig[1:] == sig[:-1]
            same[:-1] |= sig[1:] == sig[:-1]
            sig, flags, key = sig[same], flags[same], keys[local[same]]
            if not len(sig):
                continue
            key = key.view(np.int64)
            order = np.lexsort((key, sig))
            sig, flags, key = sig[order], flags[order], key[order]
            edge = np.flatnonzero(np.r_[True, sig[1:] != sig[:-1], True])
            hub = np.repeat(key[edge[:-1]], np.diff(edge))
            both = np.bitwise_or.reduceat(flags & 3, edge[:-1]) == 3  # some set asks and some is indexed
            good = np.repeat(both, np.diff(edge)) & (hub != key)
            stars = np.unique(np.stack([hub[good], key[good]]), axis=1) if good.any() else np.empty((2, 0), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in stars], ["hub", "member"])

    return entries.repartition(buckets, "bucket").mapInArrow(run, "hub long, member long")


def sketch(members: np.ndarray) -> bytes:
    """Parities of the number of elements in each of 2^(band + 2) cells, as bits."""
    cells = 1 << max(3, int(len(members)).bit_length() + 1)
    odd = np.bincount((mix(members ^ U(0x5851F42D4C957F2D)) & U(cells - 1)).astype(np.int64), minlength=cells) & 1
    return np.packbits(odd.astype(bool)).tobytes()


def parities(sets: list[np.ndarray]) -> np.ndarray:
    """WORDS 64-bit words for each set: parities of the number of elements in each of 64 WORDS cells."""
    out = np.zeros((len(sets), 64 * WORDS), np.int64)
    owner = np.repeat(np.arange(len(sets)), list(map(len, sets)))
    np.add.at(out.reshape(-1), owner * (64 * WORDS) + (mix(np.concatenate(sets) ^ U(0x2545F4914F6CDD1D)) & U(64 * WORDS - 1)).astype(np.int64), 1)
    return np.packbits(out.astype(bool) & (out % 2 == 1), axis=1).view("<i8")


def may_reach(x: bytes, y: bytes, m: int, n: int, p: int, q: int) -> bool:
    """Whether sets of m and n elements with these sketches may have J >= p / q: odd cells never outnumber differing elements."""
    a, b = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
    if len(a) > len(b):
        a = np.bitwise_xor.reduce(a.reshape(-1, len(b)), axis=0)
    elif len(b) > len(a):
        b = np.bitwise_xor.reduce(b.reshape(-1, len(a)), axis=0)
    return (p + q) * int(np.bitwise_count(a ^ b).sum()) <= (q - p) * (m + n)


def reaches(x: bytes, y: bytes, m: int, n: int, p: int, q: int) -> bool:
    """Whether two packed sets have J >= p / q."""
    a, b = np.frombuffer(x, U), np.frombuffer(y, U)
    if not len(a) or not len(b):
        return False
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    common = int((b[at] == a).sum())
    return q * common >= p * (len(a) + len(b) - common)


def compare(pairs: DataFrame, docs: DataFrame, reps: DataFrame, n: int, twins: frozenset[int], pack, holds, small: int) -> DataFrame:
    """The pairs (a, b) of keys for which holds(packed a, packed b, size of a, size of b); pack makes bytes of a set.

    What is packed is shuffled once, by a: the row of a comes first, then its partners stream past it. reps: key, rep
    (a document of that set). small: the most pairs that are broadcast to the documents, some 40 bytes each.
    """
    spark = pairs.sparkSession
    roles = pairs.select("a", F.col("b").alias("key")).unionAll(pairs.select("a", F.col("a").alias("key")).distinct())
    roles = roles.join(reps, "key").groupBy(F.col("rep").alias("w"), "key").agg(F.collect_set("a").alias("hubs"))
    roles = materialize(roles, scratch(spark, "roles"))
    few = F.broadcast(roles) if pairs.count() <= small else roles

    def made(parts):
        shingler = Shingler(n)

        def batch(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int64(), pa.binary()))], ["hub", "key", "n", "data"])

        for b in parts:
            for held in slices(b, 1 << 20):
                rows, weight = [], 0
                for s, key, hubs in zip(shingler(held.column("text")), held.column("key").to_pylist(), held.column("hubs").to_pylist()):
                    if _signed(key_of(s, twins)) != key:
                        continue  # another text of the same doc_id
                    data = pack(s)
                    for hub in hubs:
                        rows.append((hub, key, len(s), data))
                        weight += len(data)
                        if weight > 8 << 20:
                            yield batch(rows)
                            rows, weight = [], 0
                if rows:
                    yield batch(rows)

    def met(parts):
        hub = first = size = None
        for b in parts:
            a, c = [], []
            for h, key, m, data in zip(b.column("hub").to_pylist(), b.column("key").to_pylist(), b.column("n").to_pylist(), b.column("data")):
                if h == key:
                    hub, first, size = h, data.as_py(), m
                elif h == hub and holds(first, data.as_py(), size, m):
                    a.append(h)
                    c.append(key)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(c, pa.int64())], ["a", "b"])

    rows = docs.join(few, F.col("doc_id") == F.col("w")).select("text", "key", "hubs").mapInArrow(made, "hub long, key long, n long, data binary")
    return rows.repartition("hub").sortWithinPartitions(F.col("hub"), F.col("hub") != F.col("key")).mapInArrow(met, "a long, b long").distinct()


def jaccard_components(spark: SparkSession, docs: DataFrame, n: int = 5, p: int = 3, q: int = 4, entries_per_bucket: int = 500_000, small: int = 1_000_000) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of docs (doc_id, text, any others); documents of J >= p / q link.

    Null texts and texts without words have the empty set and link with nothing, not even with each other. Rows that
    repeat a doc_id are rows like others. A row without doc_id links with nothing and has no component_id. Texts of
    any length count whole; other columns, whatever their names, are not read. An empty table gives no row.
    small: the most pairs whose documents are named to all tasks (some 40 bytes each).
    """
    scheme = Scheme(p, q)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    docs = rows.where("doc_id is not null")
    spots = [scratch(spark, f"jaccard{k}") for k in range(3)]
    facts = materialize(describe(rows, n, scheme), spots[0])
    short, total = facts.agg(F.expr("bit_or(short)"), F.sum("n_shingles")).first()
    deep = (short or 0) | (1 << (SMALL.bit_length() - 1)) - 1
    # n-grams of a three-hundredth of a batch's documents, in a twentieth of all batches: a batch names few (its size over
    # a three-hundredth of its documents), so twenty times that number bounds them, whatever the corpus
    n_batches = facts.where("often is not null").count()
    often = facts.where("often is not null").select(F.explode("often").alias("h")).groupBy("h").count().where(F.col("count") >= max(2, n_batches // 20)).select("h")
    frequent = np.sort(np.array([r.h for r in often.collect()], np.int64).view(U))
    buckets = int(min(1 << 20, max(8, (total or 0) * 0.6 // entries_per_bucket + 1)))
    keyed = facts.where("n_shingles > 0 and doc_id is not null")
    of_key = keyed.groupBy("key").agg(F.min("doc_id").alias("rep"), F.min("check").alias("k0"), F.max("check").alias("k1"))
    # different sets of one 64-bit key: none in 10^9 documents, on average three in 10^10
    twins = frozenset(r.key & (1 << 64) - 1 for r in of_key.where("k0 <> k1").select("key").collect())
    if twins:
        rekey = F.udf(lambda key, check: _signed(rekeyed(key, check)) if key & (1 << 64) - 1 in twins else key, "long")
        facts = facts.withColumn("key", F.when(F.col("n_shingles") > 0, rekey("key", "check")).otherwise(F.col("key")))
        keyed = facts.where("n_shingles > 0 and doc_id is not null")
        of_key = keyed.groupBy("key").agg(F.min("doc_id").alias("rep"))
    reps = of_key.select("key", "rep")
    stars = materialize(meet(index_entries(docs, n, scheme, frequent, deep, buckets, twins), buckets).distinct(), spots[1])
    cells = keyed.groupBy(F.col("key").alias("m")).agg(F.min("n_shingles").alias("n"), *(F.min(f"c{k}").alias(f"c{k}") for k in range(WORDS)))

    def fits(x: str, y: str):
        sizes = [F.col(x + "n"), F.col(y + "n")]
        odd = sum((F.bit_count(F.col(f"{x}c{k}").bitwiseXOR(F.col(f"{y}c{k}"))) for k in range(WORDS)), F.lit(0))  # never more than differing elements
        return (p * F.greatest(*sizes) <= q * F.least(*sizes)) & (odd * (p + q) <= (q - p) * (sizes[0] + sizes[1]))

    def check(pairs):
        likely = compare(pairs, docs, reps, n, twins, sketch, lambda *x: may_reach(*x, p, q), small)
        likely = materialize(likely, scratch(spark, "plausible"))
        return compare(likely, docs, reps, n, twins, lambda s: s.tobytes(), lambda *x: reaches(*x, p, q), small)

    side = lambda s: cells.toDF(*(s + c for c in cells.columns))
    met = stars.join(side("x"), F.col("hub") == F.col("xm")).join(side("y"), F.col("member") == F.col("ym"))
    stars = materialize(met.select("hub", "member", fits("x", "y").alias("fits")), spots[2])
    release(spark)
    links = link_in_clusters(spark, stars, lambda members: members.join(cells, "m"), fits, check)
    edges = links.join(reps.toDF("a", "ra"), "a").join(reps.toDF("b", "rb"), "b").select(F.col("ra").alias("a"), F.col("rb").alias("b"))
    roots = connected_components(spark, edges).withColumnRenamed("node", "rep")
    for spot in spots[1:]:
        discard(spark, spot)
    of_key = reps.join(roots, "rep", "left").select("key", F.coalesce("component", "rep").alias("component_id"))
    full = keyed.select("doc_id", "n_shingles", "key").join(of_key, "key").select("doc_id", "n_shingles", "component_id")
    return full.unionAll(facts.where("n_shingles = 0 or doc_id is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))


def keep_one(spark: SparkSession, docs: DataFrame, **options) -> DataFrame:
    """docs with one row of each group of linked documents, that of the smallest doc_id (null first); columns as they are.

    Rows that repeat a doc_id, or have none, are documents of their own: of equal ones among them one stays, too. Rows
    without words all stay. An empty table gives no row.
    """
    rows = identified(spark, docs)
    found = jaccard_components(spark, rows.select(F.col("_row").alias("doc_id"), F.col(f"_col{docs.columns.index('text')}").alias("text")), **options)
    gone = found.where("component_id < doc_id").select(F.col("doc_id").alias("g_row"))
    return rows.join(gone, F.col("_row") == F.col("g_row"), "left_anti").drop("_row").toDF(*docs.columns)
