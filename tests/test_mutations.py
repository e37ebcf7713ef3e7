"""Mutations, checks and graph times as expressions, against plain Python on random graphs."""

import json
import random

import pytest
from pyspark.sql import functions as F

from taskloom.functions import fixed, graphs
from taskloom.operators import mutations, validation
from taskloom.schema import GRAPH, SPEC
from tests import plain


def random_graph(draw, kind):
    n = draw.randint(1, 6)
    amounts = lambda names, most: {k: draw.randint(0, most) for k in names if draw.random() < 0.8}
    acts = []
    for k in range(2, n + 2):
        if kind == "TYPE-B":
            modes = [{"mode_id": j + 1, "duration": draw.randint(1, 6), "renewable_demands": amounts(("R1", "R2"), 3), "nonrenewable_demands": amounts(("NR1",), 3)} for j in range(draw.randint(1, 3))]
            acts.append({"id": k, "duration": None, "demands": None, "modes": modes})
        else:
            acts.append({"id": k, "duration": draw.randint(1, 6), "demands": amounts(("R1", "R2"), 3), "modes": None})
    resources = [{"id": r, "capacity": draw.randint(2, 6), "type": "renewable", "downtime": []} for r in ("R1", "R2")]
    if kind == "TYPE-B":
        resources.append({"id": "NR1", "capacity": draw.randint(4, 14), "type": "nonrenewable", "downtime": None})
    edges = {}
    for _ in range(draw.randint(0, 6)):
        i, j = draw.randint(2, n + 1), draw.randint(2, n + 1)
        if i < j or draw.random() < 0.1:
            relation = draw.choice(fixed.RELATIONS) if kind == "TYPE-C" else "FS"
            low = draw.randint(0, 3)
            edges[i, j, relation] = {"i": i, "j": j, "relation": relation, "lag_min": low, "lag_max": low + draw.randint(-1, 9) if kind == "TYPE-C" and draw.random() < 0.4 else None}
    return {"instance_id": "x", "type": kind, "activities": acts, "resources": resources, "precedences": list(edges.values()), "objective": {"type": "minimize_makespan"}, "mutations_applied": []}


def random_spec(draw, graph):
    known = [a["id"] for a in graph["activities"]]
    some = lambda: draw.choice([*known, *known, *known, 99])
    op = draw.choice(fixed.ALLOWED_OPS[graph["type"]]) if draw.random() < 0.95 else draw.choice([*mutations.OPERATIONS, "paint"])
    resource = draw.choice(["R1", "R2", "R1", "R2", "NR1", "R9"])
    if op in ("reduce_capacity", "freeze_resource"):
        start = draw.randint(0, 9)
        return {"op": op, "resource": resource, "delta": draw.randint(0, 5), "t_start": start, "t_end": start + draw.choice([0, 1, 3, 9, 80])}
    if op == "enforce_time_lag":
        low = draw.randint(-1, 4)
        return {"op": op, "i": some(), "j": some(), "relation": draw.choice([*fixed.RELATIONS, *fixed.RELATIONS, *fixed.RELATIONS, "XX"]), "lag_min": low, "lag_max": draw.choice([None, None, low + draw.randint(0, 9)])}
    if op == "add_precedence":
        return {"op": op, "i": some(), "j": some(), "relation": draw.choice([None, "FS", "SS"])}
    if op == "alter_objective":
        return {"op": op, "obj_type": draw.choice([*fixed.OBJECTIVES, "be happy"]), "task_weights": draw.choice([None, {"2": 2.0}]), "task_deadlines": draw.choice([None, {"2": 4}])}
    if op == "reduce_nonrenewable_budget":
        return {"op": op, "resource": draw.choice(["NR1", "NR1", "NR1", "R1"]), "delta": draw.randint(-1, 9)}
    if op == "restrict_modes":
        return {"op": op, "activity_id": some(), "remove_mode_ids": draw.sample([1, 2, 3], draw.randint(1, 2))}
    if op == "add_mode":
        return {"op": op, "activity_id": known[0], "duration": draw.randint(0, 5), "renewable_demands": draw.choice([None, {"R1": 2}, {"R2": -1}]), "nonrenewable_demands": {"NR1": draw.randint(0, 2)}}
    return {"op": op, "activity_id": some(), "mode_id": draw.randint(1, 3), "duration_delta": draw.randint(-3, 3), "demand_deltas": draw.choice([None, {"R1": -2, "R7": 1}]), "nonrenewable_deltas": draw.choice([None, {"NR1": 1}])}


def judged(graph, specs):
    reason = plain.form_reason(specs, graph["type"]) or plain.spec_reason(specs, graph)
    made = None if reason else plain.mutate(graph, specs)
    return made, reason or plain.after_reason(made)


def bare(value):
    """Without nulls, as JSON has it."""
    if isinstance(value, dict):
        return {k: bare(v) for k, v in value.items() if v is not None}
    return [bare(v) for v in value] if isinstance(value, list) else value


@pytest.fixture(scope="module")
def cases(spark):
    draw = random.Random(11)
    out = []
    for k in range(900):
        graph = random_graph(draw, draw.choice(["TYPE-A", "TYPE-B", "TYPE-C"]))
        out.append((k, json.dumps(graph), json.dumps([random_spec(draw, graph) for _ in range(draw.choice([0, 1, 1, 1, 2, 3]))])))
    rows = spark.createDataFrame(out, "k int, g string, s string").repartition(4)
    return out, rows.select("k", F.from_json("g", GRAPH).alias("g"), F.from_json("s", f"array<{SPEC}>").alias("s")).cache()


def test_validated_mutation(cases):
    plain_rows, rows = cases
    got = {r.k: (r.graph, r.reason) for r in rows.select("k", validation.validated_mutation(F.col("g"), F.col("s")).alias("m")).select("k", F.to_json("m.graph").alias("graph"), "m.reason").collect()}
    reasons, done = set(), set()
    for k, g, s in plain_rows:
        made, reason = judged(json.loads(g), json.loads(s))
        assert got[k][1] == reason, (g, s)
        reasons.add((reason or "made").split(":")[-1].strip()[:16])
        if reason is None:
            assert bare(json.loads(got[k][0])) == bare(made), (g, s)
            done |= {m["op"] for m in json.loads(s)}
    assert done == set(mutations.OPERATIONS) and len(reasons) > 20


def test_times_of_graphs(cases):
    plain_rows, rows = cases
    got = {r.k: r for r in rows.select("k", graphs.cycle_reason(F.col("g.activities"), F.col("g.precedences")).alias("cycle"), graphs.critical_path(F.col("g.activities"), F.col("g.precedences")).alias("path")).collect()}
    for k, g, _ in plain_rows:
        graph = json.loads(g)
        days = {a["id"]: graphs.duration_of(a) for a in graph["activities"]}
        assert (got[k].cycle, got[k].path) == (plain.cycle_reason(graph), plain.longest_path(days, [(p["i"], p["j"]) for p in graph["precedences"]])), g


def test_no_activities(spark):
    rows = spark.createDataFrame([('{"type": "TYPE-A", "activities": [], "resources": [], "precedences": []}',), ("{}",)], "g string").select(F.from_json("g", GRAPH).alias("g"))
    assert [tuple(r) for r in rows.select(graphs.critical_path(F.col("g.activities"), F.col("g.precedences")), graphs.cycle_reason(F.col("g.activities"), F.col("g.precedences"))).collect()] == [(None, None)] * 2


def test_consistency_gate(spark):
    """Gate 6 against plain Python: random models, and texts that tell of some of what they have."""
    from taskloom.functions import gates

    draw, rows, want = random.Random(12), [], {}
    lines = [
        "Resource R1 is offline from hour 4.", "R2 a b c d e f g h i j offline", "R2 a b c d e f g h i j k offline", "Maintenance blocked the R2 of today", "r1, offline!", "NR1 drops to 3.", "Team R10 is down.",
        "Between T2 and T3 a waiting period holds.", "T2 and T3 must wait.", "T2, T3 and T4 start together? Simultaneously", "T3 and T4 finish together.", "T3 and T5 must wait! T2", "A penalty for each late day.", "There is a buffer.", "The budget counts.",
        "T2 is forced to its remaining modes.", "T3 cannot use the fast mode.", "T12 is restricted to one.", "Nothing else.",
    ]
    for k in range(700):
        base = random_graph(draw, draw.choice(["TYPE-A", "TYPE-B", "TYPE-C"]))
        try:
            model = plain.mutate(base, [random_spec(draw, base) for _ in range(draw.choice([0, 1, 1, 2]))])
        except (plain.Refused, KeyError, TypeError):
            continue
        part = draw.choice([" ", "\n"]).join(draw.choice(lines) for _ in range(draw.randint(1, 4))) if k % 20 else None
        text = "CONTEXT: x" + ("" if part is None else f"\n\nDISRUPTION:{part}\n\nR1 is offline")
        rows.append((k, text, json.dumps(model), json.dumps(base)))
        want[k] = plain.consistency_of(part, model, base)
    table = spark.createDataFrame(rows, "k int, p string, m string, b string").select("k", "p", F.from_json("m", GRAPH).alias("m"), F.from_json("b", GRAPH).alias("b"))
    got = {r.k: r.reason for r in table.select("k", gates.consistency_reason(F.col("p"), F.col("m"), F.col("b")).alias("reason")).collect()}
    kinds = {"pass" if r is None else r.split()[-2] if "tell" not in r else r.split()[6] for r in want.values()}
    assert {k: r and r.lower() for k, r in got.items()} == {k: r and r.lower() for k, r in want.items()}
    assert kinds >= {"pass", "downtime", "time_lag", "mode_restriction", "objective_change"} and any(r and "stops" in r for r in want.values())


def test_specs_are_made_once(spark):
    """The expression that makes the specs stands once in a validated mutation, however often they are looked at."""
    from pyspark.sql import functions as F
    from taskloom.operators.validation import validated_mutation
    from taskloom.schema import GRAPH, SPEC

    rows = spark.createDataFrame([("{}", "[]")], "g string, s string").select(F.from_json("g", GRAPH).alias("g"), "s")
    made = rows.select(validated_mutation(F.col("g"), F.from_json("s", f"array<{SPEC}>")).alias("made"))
    assert made._jdf.queryExecution().analyzed().toString().count("from_json") == 2  # the graph, and the specs
    assert made.first().made.reason == "no mutations"
