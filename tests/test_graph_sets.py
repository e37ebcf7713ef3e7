"""Times of many graphs as sets, against plain Python on random graphs, cycles included."""

import random

from taskloom.functions import fixed, graphs
from taskloom.operators import graph_sets
from tests import plain


def test_random_graphs(spark):
    draw = random.Random(9)
    days, edges, want = [], [], {}
    for g in range(250):
        n = draw.randint(1, 6)
        acts = [{"id": k, "duration": draw.randint(1, 5)} for k in range(1, n + 1)]
        links = []
        for _ in range(draw.randint(0, 8)):
            i, j = draw.randint(1, n), draw.randint(1, n)
            low = draw.randint(-9, 3)
            links.append({"i": i, "j": j, "relation": draw.choice(fixed.RELATIONS), "lag_min": low, "lag_max": draw.choice([None, None, low + draw.randint(0, 9)])})
        graph = {"activities": acts, "precedences": links}
        bad = graphs.earliest_starts([a["id"] for a in acts], graphs.distance_edges(graph)) is None
        want[g] = bad, plain.longest_path({a["id"]: a["duration"] for a in acts}, [(p["i"], p["j"]) for p in links])
        days += [(g, a["id"], a["duration"]) for a in acts]
        edges += [(g, p["i"], p["j"], p["relation"], p["lag_min"], p["lag_max"]) for p in links]
    d = spark.createDataFrame(days, "g int, id int, duration int").repartition(3)
    e = spark.createDataFrame(edges, "g int, i int, j int, relation string, lag_min int, lag_max int").repartition(3)
    cycles = {r.g: r.infeasible for r in graph_sets.positive_cycles(d, graph_sets.distance_table(e, d, "g"), "g").collect()}
    paths = {r.g: r.length for r in graph_sets.critical_paths(d, e, "g").collect()}
    assert {g: (cycles[g], paths[g]) for g in want} == want and 20 < sum(b for b, _ in want.values()) < 230
    none = d.limit(0)
    assert graph_sets.positive_cycles(none, graph_sets.distance_table(e, none, "g"), "g").collect() == []
    assert graph_sets.critical_paths(none, e, "g").collect() == []


def test_rows_and_rounds_agree(spark):
    draw = random.Random(4)
    days, edges = [], []
    for g in range(60):
        n = draw.randint(1, 6)
        days += [(g, k, draw.randint(1, 5)) for k in range(1, n + 1)]
        edges += [(g, draw.randint(1, n + 1), draw.randint(1, n + 1), draw.choice(fixed.RELATIONS), draw.randint(-9, 3), draw.choice([None, 4])) for _ in range(draw.randint(0, 8))]
    edges += [(None, 1, 2, "FS", 1, None), (99, 1, 1, "FS", 1, None)]
    d = spark.createDataFrame(days, "g int, id int, duration int").repartition(2)
    e = spark.createDataFrame(edges, "g int, i int, j int, relation string, lag_min int, lag_max int").repartition(2)
    cycles, paths = [], []
    for most in (0, 7, 48):  # all by rounds, some in a row, all in a row
        cycles.append(sorted(graph_sets.infeasible_graphs(d, e, "g", most).collect()))
        paths.append(sorted(graph_sets.critical_paths(d, e, "g", most).collect()))
    assert cycles[0] == cycles[1] == cycles[2] and len(cycles[0]) == 60 and 5 < sum(r.infeasible for r in cycles[0]) < 55
    assert paths[0] == paths[1] == paths[2] and len(paths[0]) == 60
