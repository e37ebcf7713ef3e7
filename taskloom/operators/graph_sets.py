"""Times of many graphs at once, over tables of activities and edges.

Graphs of any size fit: those of up to IN_A_ROW activities and edges are grouped into a row by one shuffle and done there;
larger ones, which no row should hold, go through rounds of joins with one aggregation each. Such a graph leaves the
rounds when it stands still, so their number follows the deepest graph and their size the graphs that still move.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.graphs import distances, layers, let, positive_cycle
from ..schema import ACTIVITY, EDGE
from ..sources.staging import dropped, staged

IN_A_ROW = 48


def _by_size(days: DataFrame, edges: DataFrame, graph: str, node: Column, edge: Column, most: int):
    """Rows of graph, nodes, edges of the graphs of at most so many of both, and the days and edges of the others, if any.

    Edges of no graph are left out, and what has edges only is no graph.
    """
    edges = edges.where(F.col(graph).isNotNull())
    large = edges.select(graph).unionAll(days.select(graph)).groupBy(graph).agg(F.count("*").alias("n")).where(F.col("n") > most).select(F.col(graph).alias("_large"))
    large = staged(large, "large")
    rest = None
    if not large.isEmpty():
        theirs = F.col(graph).eqNullSafe(F.col("_large"))
        rest = days.join(large, theirs, "left_semi"), edges.join(large, theirs, "left_semi")
        days, edges = days.join(large, theirs, "left_anti"), edges.join(large, theirs, "left_anti")
    kind = lambda of, c: of.select(c).schema[0].dataType
    no_node, no_edge = F.lit(None).cast(kind(days, node)), F.lit(None).cast(kind(edges, edge))
    both = days.select(graph, node.alias("node"), no_edge.alias("edge")).unionAll(edges.select(graph, no_node.alias("node"), edge.alias("edge")))
    return both.groupBy(graph).agg(F.collect_list("node").alias("nodes"), F.collect_list("edge").alias("edges")).where(F.size("nodes") > 0), rest


def infeasible_graphs(days: DataFrame, edges: DataFrame, graph: str, most: int = IN_A_ROW) -> DataFrame:
    """graph, infeasible: some cycle of the distances of edges (graph, i, j, relation, lag_min, lag_max) between
    activities (graph, id, duration) has a positive length."""
    node = F.struct("id", "duration", F.lit(None).alias("demands"), F.lit(None).alias("modes")).cast(ACTIVITY)
    rows, rest = _by_size(days, edges, graph, node, F.struct("i", "j", "relation", "lag_min", "lag_max").cast(EDGE), most)
    out = rows.select(graph, let(distances(F.col("nodes"), F.col("edges")), lambda e: positive_cycle(F.col("nodes"), e)).alias("infeasible"))
    return out if rest is None else out.unionAll(positive_cycles(rest[0], distance_table(rest[1], rest[0], graph), graph))


def distance_table(edges: DataFrame, days: DataFrame, graph: str) -> DataFrame:
    """graph, source, target, weight: start-to-start distances of edges (graph, i, j, relation, lag_min, lag_max) by the
    durations (graph, id, duration) of their ends; a maximal lag is an edge backwards. Edges of unknown ends are left out."""
    at = lambda k, name: days.select(F.col(graph).alias(f"_g{k}"), F.col("id").alias(f"_{k}"), F.col("duration").alias(name))
    e = edges.join(at("i", "di"), (F.col(graph) == F.col("_gi")) & (F.col("i") == F.col("_i"))).join(at("j", "dj"), (F.col(graph) == F.col("_gj")) & (F.col("j") == F.col("_j")))
    lo, hi, di, dj = F.coalesce("lag_min", F.lit(0)), F.col("lag_max"), F.col("di"), F.col("dj")
    by = lambda **w: F.coalesce(*(F.when(F.col("relation") == k, v) for k, v in w.items()))
    there = F.struct(F.col("i").alias("source"), F.col("j").alias("target"), by(FS=di + lo, SS=lo, FF=di - dj + lo, SF=lo - dj).alias("weight"))
    back = F.struct(F.col("j").alias("source"), F.col("i").alias("target"), by(FS=-(di + hi), SS=-hi, FF=dj - di - hi, SF=dj - hi).alias("weight"))
    return e.select(graph, F.explode(F.array(there, back)).alias("e")).select(graph, "e.*").where("weight is not null")


def positive_cycles(days: DataFrame, distances: DataFrame, graph: str) -> DataFrame:
    """graph, infeasible: some cycle of its distances has a positive length.

    Every activity starts at 0 and moves to the greatest of start + weight over what leads to it, all at once. A graph
    without positive cycles stands still after as many rounds as it has activities; one that moves in a further round
    has such a cycle, and is done as well.
    """
    size = days.groupBy(graph).agg(F.count("*").alias("n"))
    state = staged(days.select(graph, F.col("id").alias("node"), F.lit(0).cast("long").alias("start")).join(size, graph), "starts")
    edges = staged(distances.select(F.col(graph).alias("_g"), F.col("source"), F.col("target"), F.col("weight").cast("long").alias("weight")), "distances")
    found, rounds, moving = [], 0, 1
    while moving:
        rounds += 1
        best = state.join(edges, (F.col(graph) == F.col("_g")) & (F.col("node") == F.col("source"))).groupBy(F.col("_g"), F.col("target")).agg(F.max(F.col("start") + F.col("weight")).alias("later"))
        moved = state.join(best, (F.col(graph) == F.col("_g")) & (F.col("node") == F.col("target")), "left").select(graph, "node", "n", F.greatest("start", F.coalesce("later", "start")).alias("now"), (F.col("later") > F.col("start")).alias("moved"))
        active = moved.where("moved").select(graph, F.col("n").alias("_n")).distinct()
        late = staged(active.where(F.col("_n") < rounds).select(graph), "late")
        found.append(late)
        seen, last = Observation(), state
        rest = moved.join(active.where(F.col("_n") >= rounds).select(graph), graph, "left_semi").select(graph, "node", F.col("now").alias("start"), "n")
        state = staged(rest.observe(seen, F.count("*").alias("rows")), "starts")
        moving = seen.get["rows"]
        dropped(last)
    bad = found[0]
    for more in found[1:]:
        bad = bad.unionAll(more)
    return size.select(graph).join(bad.withColumn("infeasible", F.lit(True)), graph, "left").select(graph, F.coalesce("infeasible", F.lit(False)).alias("infeasible"))


def critical_paths(days: DataFrame, edges: DataFrame, graph: str, most: int = IN_A_ROW) -> DataFrame:
    """graph, length: the longest chain of durations, edges (graph, i, j) read finish to start without lags."""
    rows, rest = _by_size(days, edges, graph, F.struct("id", F.col("duration").cast("long").alias("days")), F.struct("i", "j"), most)
    ids = F.transform("nodes", lambda a: a["id"])
    at = lambda k: F.array_position(ids, k).cast("int")
    places = F.transform("edges", lambda e: F.struct(at(e["i"]).alias("i"), at(e["j"]).alias("j")))
    known = F.filter(places, lambda e: (e["i"] > 0) & (e["j"] > 0))
    out = rows.select(graph, let(known, lambda e: F.array_max(layers(F.transform("nodes", lambda a: a["days"]), e)["finish"])).alias("length"))
    return out if rest is None else out.unionAll(layered_paths(*rest, graph))


def layered_paths(days: DataFrame, edges: DataFrame, graph: str) -> DataFrame:
    """The critical paths of graphs of any size, by rounds.

    Activities leave in layers, each when all before it have left. What lies on a cycle, or after one, keeps what it has
    so far, which counts.
    """
    key = lambda name: (F.col(graph) == F.col("_g")) & (F.col("node") == F.col(name))
    nodes = days.select(graph, F.col("id").alias("node"), F.col("duration").cast("long").alias("days"))
    links = edges.select(F.col(graph).alias("_g"), "i", "j")
    links = staged(links.join(nodes.select(F.col(graph).alias("_a"), F.col("node").alias("_i")), (F.col("_g") == F.col("_a")) & (F.col("i") == F.col("_i")), "left_semi"), "links")
    waits = links.groupBy("_g", "j").agg(F.count("*").alias("w"))
    state = nodes.join(waits, key("j"), "left").select(graph, "node", "days", F.col("days").alias("finish"), F.coalesce("w", F.lit(0)).cast("long").alias("waiting"))
    state = staged(state.withColumn("ready", F.col("waiting") == 0), "layers")
    done, going = [], state.where("ready").limit(1).count()
    while going:
        told = state.where("ready").join(links, key("i")).groupBy("_g", "j").agg(F.max("finish").alias("before"), F.count("*").alias("left"))
        done.append(staged(state.where("ready").groupBy(graph).agg(F.max("finish").alias("finish")), "done"))
        seen, last = Observation(), state
        rest = state.where("not ready").join(told, key("j"), "left")
        left = (F.col("waiting") - F.coalesce("left", F.lit(0))).cast("long")
        rest = rest.select(graph, "node", "days", F.greatest("finish", F.coalesce(F.col("before") + F.col("days"), "finish")).alias("finish"), left.alias("waiting"), (left == 0).alias("ready"))
        state = staged(rest.observe(seen, F.count_if("ready").alias("n")), "layers")
        going = seen.get["n"]
        dropped(last)
    ends = state.groupBy(graph).agg(F.max("finish").alias("finish"))
    for part in done:
        ends = ends.unionAll(part)
    return ends.groupBy(graph).agg(F.max("finish").alias("length"))
