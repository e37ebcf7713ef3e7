"""Graph algorithms on one project, in its row: projects are small, so nothing is shuffled.

Times of graphs are expressions over the nested columns (`critical_path`, `cycle_reason`); the scheduler's own loops use
the plain functions above them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .metrics import duration


def duration_of(activity: dict) -> int:
    if activity.get("duration") is not None:
        return activity["duration"]
    return min(m["duration"] for m in activity["modes"])


#: (weight of i -> j, weight of j -> i) by relation, from the two durations and the lags
WEIGHTS = {
    "FS": (lambda di, dj, lo: di + lo, lambda di, dj, hi: -(di + hi)),
    "SS": (lambda di, dj, lo: lo, lambda di, dj, hi: -hi),
    "FF": (lambda di, dj, lo: di - dj + lo, lambda di, dj, hi: dj - di - hi),
    "SF": (lambda di, dj, lo: lo - dj, lambda di, dj, hi: dj - hi),
}


def distance_edges(graph: dict) -> list[tuple[int, int, int]]:
    """Start-to-start distances (from, to, least); a maximal lag is an edge backwards."""
    d = {a["id"]: duration_of(a) for a in graph["activities"]}
    out = []
    for p in graph.get("precedences") or []:
        i, j = p["i"], p["j"]
        forward, backward = WEIGHTS.get(p["relation"], (None, None))
        if forward is None or i not in d or j not in d:
            continue
        out.append((i, j, forward(d[i], d[j], p.get("lag_min") or 0)))
        if p.get("lag_max") is not None:
            out.append((j, i, backward(d[i], d[j], p["lag_max"])))
    return out


def earliest_starts(nodes: list[int], edges: list[tuple[int, int, int]]) -> dict[int, int] | None:
    """Longest distances from a common origin at 0, or None if some cycle has a positive length."""
    start = dict.fromkeys(nodes, 0)
    for _ in range(len(start) + 1):
        moved = False
        for i, j, w in edges:
            if start[i] + w > start[j]:
                start[j], moved = start[i] + w, True
        if not moved:
            return start
    return None


def let(value: Column, body) -> Column:
    """body(value) with value evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _none(array: Column, like: str) -> Column:
    return F.coalesce(array, F.array().cast(like))


LINK = "array<struct<i:int,j:int,w:int>>"


def links(activities: Column, precedences: Column) -> Column:
    """Edges between known activities as places in the list (from 1)."""
    ids = F.transform(activities, lambda a: a["id"])
    at = lambda k: F.array_position(ids, k).cast("int")
    known = F.filter(_none(precedences, "array<struct<i:int,j:int,relation:string,lag_min:int,lag_max:int>>"), lambda p: F.array_contains(ids, p["i"]) & F.array_contains(ids, p["j"]))
    return F.transform(known, lambda p: F.struct(at(p["i"]).alias("i"), at(p["j"]).alias("j"), F.lit(0).alias("w")))


def distances(activities: Column, precedences: Column) -> Column:
    """Start-to-start distances (i, j as places from 1, w the least); a maximal lag is an edge backwards."""
    ids = F.transform(activities, lambda a: a["id"])
    days = F.transform(activities, duration)
    at = lambda k: F.array_position(ids, k).cast("int")

    def both(p):
        i, j, lo, hi, kind = at(p["i"]), at(p["j"]), F.coalesce(p["lag_min"], F.lit(0)), p["lag_max"], p["relation"]
        di, dj = F.element_at(days, i), F.element_at(days, j)
        there, back = (F.coalesce(*(F.when(kind == name, rule[side](di, dj, lag)) for name, rule in WEIGHTS.items())) for side, lag in ((0, lo), (1, hi)))
        return F.array(F.struct(i.alias("i"), j.alias("j"), there.alias("w")), F.struct(j.alias("i"), i.alias("j"), back.alias("w")))

    known = F.filter(_none(precedences, "array<struct<i:int,j:int,relation:string,lag_min:int,lag_max:int>>"), lambda p: F.array_contains(ids, p["i"]) & F.array_contains(ids, p["j"]))
    return F.filter(F.flatten(F.transform(known, both)), lambda e: e["w"].isNotNull())  # no maximal lag, no way back


def layers(days: Column, edges: Column) -> Column:
    """struct<finish, waiting>: activities leave in layers, each when all before it have left; finish is the end of the
    longest chain, read finish to start without lags. What lies on a cycle, or after one, keeps what it has so far."""
    n = F.size(days)
    places = F.sequence(F.lit(1), n)
    into = lambda some, k: F.filter(some, lambda e: e["j"] == k)
    waiting = F.transform(places, lambda k: F.size(into(edges, k)))
    first = F.struct(days.alias("finish"), waiting.alias("waiting"), F.filter(places, lambda k: ~F.exists(edges, lambda e: e["j"] == k)).alias("ready"))

    def step(s, _):
        touched = F.filter(edges, lambda e: F.array_contains(s["ready"], e["i"]))

        def moved(t):
            chain = lambda k: F.array_max(F.transform(into(t, k), lambda e: F.element_at(s["finish"], e["i"]))) + F.element_at(days, k)
            finish = F.transform(places, lambda k: F.greatest(F.element_at(s["finish"], k), chain(k)))
            left = F.transform(places, lambda k: F.element_at(s["waiting"], k) - F.size(into(t, k)))
            return let(left, lambda w: F.struct(finish.alias("finish"), w.alias("waiting"), F.filter(places, lambda k: (F.element_at(w, k) == 0) & (F.element_at(s["waiting"], k) > 0)).alias("ready")))

        return F.when(F.size(s["ready"]) == 0, s).otherwise(let(touched, moved))

    return F.aggregate(places, first, step)


def critical_path(activities: Column, precedences: Column) -> Column:
    """Longest chain of least durations; null without activities."""
    path = let(links(activities, precedences), lambda e: let(F.transform(activities, duration), lambda d: F.array_max(layers(d, e)["finish"])))
    return F.when(F.size(activities) > 0, path)


def positive_cycle(activities: Column, edges: Column) -> Column:
    """Some cycle has a positive length: the latest of all walks still grows after as many rounds as there are activities."""
    places = F.sequence(F.lit(1), F.size(activities))
    first = F.struct(F.transform(places, lambda k: F.lit(0)).alias("start"), F.lit(True).alias("moved"))

    def step(s, _):
        later = lambda k: F.array_max(F.transform(F.filter(edges, lambda e: e["j"] == k), lambda e: F.element_at(s["start"], e["i"]) + e["w"]))
        start = F.transform(places, lambda k: F.greatest(F.element_at(s["start"], k), later(k)))
        return F.when(~s["moved"], s).otherwise(let(start, lambda t: F.struct(t.alias("start"), (t != s["start"]).alias("moved"))))

    return F.aggregate(F.sequence(F.lit(0), F.size(activities)), first, step, lambda s: s["moved"])


def cycle_reason(activities: Column, precedences: Column) -> Column:
    """Why the graph cannot be scheduled in time, null if it can."""
    lagged = F.exists(precedences, lambda p: p["lag_max"].isNotNull() | p["relation"].isin("FF", "SF"))
    positive = let(distances(activities, precedences), lambda e: positive_cycle(activities, e))
    stuck = let(links(activities, precedences), lambda e: F.exists(layers(F.transform(activities, lambda a: F.lit(0)), e)["waiting"], lambda w: w > 0))
    found = F.when(F.coalesce(lagged, F.lit(False)), F.when(positive, "temporal constraints form a positive cycle")).otherwise(F.when(stuck, "precedences form a cycle"))
    return F.when(F.size(activities) > 0, found)
