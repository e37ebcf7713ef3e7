"""Connected components of an edge table, and links inside clusters of candidates (DataFrame operations only)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, materialize, release, scratch

#: Clusters of up to so many rows are compared pair by pair at once, where larger ones have another way (`near`).
FEW = 64


def connected_components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """node, component (its smallest node) of every node that has an edge to another one; edges: a, b (long, any order).

    Loops, repeated edges and edges with a null end add nothing. Minima are pre-aggregated before the shuffle, and the
    joins back are on keys whose other side is unique, so adaptive execution can split a node with very many edges.
    Each round is written to the shared space; only two numbers of a round reach the driver.
    """
    path = scratch(spark, "stars")
    now = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    now, before = materialize(now, path), None
    while True:
        both = now.select(F.col("u").alias("a"), F.col("v").alias("b")).unionAll(now.select(F.col("v").alias("a"), F.col("u").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("k"), F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, F.col("a") == F.col("k")).select(F.col("b").alias("u"), F.col("m").alias("v")).distinct()
        roots = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(roots.withColumnRenamed("u", "k"), F.col("u") == F.col("k")).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = moved.unionAll(roots.select("u", F.col("m").alias("v"))).distinct()
        after_path = scratch(spark, "stars")
        now = materialize(small, after_path)
        discard(spark, path)
        path = after_path
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(now.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
        before = mark


def link_in_clusters(spark: SparkSession, stars: DataFrame, sketch: Callable[[DataFrame], DataFrame], fits: Callable, check: Callable[[DataFrame], DataFrame], turns: int = 1, picks: int = 4, near: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Edges (a, b) that connect all members who are connected by pairs of one cluster that pass `check`, and no others.

    stars: hub, member (long, distinct, hub <> member); a hub and its members are one cluster. First each member is
    compared with its hub (if there is a column fits: where that is true), then, `turns` times, with some `picks` others of its cluster that it is not connected with
    yet. What is then still unconnected inside a cluster, few where a cluster is alike, is compared pair by pair.
    sketch gives the columns (m, any others) of members (m) by which fits(x, y), over columns prefixed by x and y,
    rules a pair out. Groups of candidates that share most members should have the same hub (the least of a hash): then a pair
    stands in few clusters, however many groups it shares.

    near: gives, of rows (hub, member, root), every pair (a, b) of a cluster and different roots that check can pass, and
    few others. It has what is unconnected in clusters of more than FEW rows, those of connected hubs
    as one under their root, so that a line stands once where many hubs share it; smaller ones meet pair by pair at once.
    """
    ordered = lambda x, y: (F.least(x, y).alias("a"), F.greatest(x, y).alias("b"))
    first = stars.where("fits") if "fits" in stars.columns else stars
    tried = materialize(first.select(*ordered("hub", "member")).distinct(), scratch(spark, "pairs"))
    stars = stars.select("hub", "member")
    links = materialize(check(tried), scratch(spark, "links"))
    everyone = stars.unionAll(stars.select("hub", F.col("hub").alias("member")).distinct())
    known, edges, fresh, limit = None, None, links, 2
    for turn in range(1, turns + 2):
        release(spark)
        roots = connected_components(spark, fresh if edges is None else edges.unionAll(fresh))
        edges = roots.select(F.col("node").alias("a"), F.col("component").alias("b"))
        marked = everyone.join(roots, F.col("member") == F.col("node"), "left").select("hub", "member", F.coalesce("component", "member").alias("root"))
        mixed = marked.groupBy("hub").agg(F.min("root").alias("r0"), F.max("root").alias("r1"), F.count("*").alias("n")).where(f"r0 <> r1 and n > {limit}").select("hub", (F.col("n") > FEW).alias("large"))
        held = materialize(marked.join(mixed, "hub"), scratch(spark, "open"))
        open_ = held.where("hub <> member")  # the hub has met all
        if near is not None and turn > turns:
            heads = held.where("hub = member").select("hub", F.col("root").alias("head"))
            pairs = near(held.join(heads, "hub").select(F.col("head").alias("hub"), "member", "root").where("hub <> member").distinct())
        else:
            if known is None:
                known = materialize(sketch(open_.select(F.col("member").alias("m")).distinct()), scratch(spark, "sketches"))
            rows = open_.join(known, F.col("member") == F.col("m")).drop("m")
            pairs = _met(rows, fits, turn if turn <= turns else 0, picks, near is not None)
        pairs = pairs.select(*ordered("xmember", "ymember")).distinct().join(tried, ["a", "b"], "left_anti")
        pairs = materialize(pairs, scratch(spark, "pairs"))
        fresh = materialize(check(pairs), scratch(spark, "links"))
        links, tried = links.unionAll(fresh), tried.unionAll(pairs)
        if near is not None:
            limit = FEW
            if turn <= turns and open_.where("large").isEmpty():
                break
    release(spark)
    return edges.unionAll(fresh)


def _met(rows: DataFrame, fits: Callable, turn: int, picks: int, at_once: bool) -> DataFrame:
    """xmember, ymember of rows of one hub and different roots that fit: all pairs in turn 0, else all rows with some picks.

    at_once: in clusters that are not large, all pairs in any turn.
    """
    large = F.col("large")
    mine = rows.drop("large").toDF(*(c if c == "hub" else "x" + c for c in rows.columns if c != "large"))
    different = (F.col("xmember") != F.col("ymember")) & (F.col("xroot") != F.col("yroot")) & fits("x", "y")
    out = None
    if turn:
        some = rows.where(large) if at_once else rows
        row = F.struct(*(F.col(c).alias("y" + c) for c in rows.columns if c not in ("hub", "large")))
        picked = F.array(*(F.min_by(row, F.xxhash64("member", F.lit(10 * turn + k))) for k in range(picks)))
        other = some.groupBy("hub").agg(picked.alias("y")).select("hub", F.explode(F.array_distinct("y")).alias("y")).select("hub", "y.*")
        out = mine.join(other, "hub").where(different).select("xmember", "ymember")
    if at_once or not turn:
        every = (rows.where(~large) if at_once else rows).drop("large")
        other = every.toDF(*("other_hub" if c == "hub" else "y" + c for c in every.columns))
        pairs = mine.join(other, (F.col("hub") == F.col("other_hub")) & (F.col("xmember") < F.col("ymember")) & different).select("xmember", "ymember")
        out = pairs if out is None else out.unionAll(pairs)
    return out
