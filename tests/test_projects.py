"""Project graphs: parsing, metrics, mutations, validation, gates, dedup and the batch job, on hand-made fixtures."""

import json
import random

import pytest
from pyspark.sql import functions as F

from taskloom.functions import fixed, gates, graphs, metrics, minhash, text
from taskloom.operators import dedup
from taskloom.operators.solver import solve_project
from taskloom.plans import batch
from taskloom.sources import projects, providers
from tests import plain
from tests.plain import Refused, after_reason, form_reason, least_budget, mutate, spec_reason

RULE = "*" * 72
SM = f"""jobs (incl. supersource/sink ):  6
horizon                       :  10
RESOURCES
  - renewable                 :  2   R
  - nonrenewable              :  0   N
{RULE}
PRECEDENCE RELATIONS:
jobnr.    #modes  #successors   successors
   1        1          2           2   3
   2        1          1           4
   3        1          2           4   5
   4        1          1           6
   5        1          1           6
   6        1          0
{RULE}
REQUESTS/DURATIONS:
jobnr. mode duration  R 1  R 2
{RULE.replace("*", "-")}
  1      1     0       0    0
  2      1     3       2    0
  3      1     2       1    1
  4      1     4       0    2
  5      1     1       3    1
  6      1     0       0    0
{RULE}
RESOURCEAVAILABILITIES:
  R 1  R 2
    4    2
{RULE}
"""
MM = f"""jobs (incl. supersource/sink ):  4
RESOURCES
  - renewable                 :  1   R
  - nonrenewable              :  1   N
{RULE}
PRECEDENCE RELATIONS:
jobnr.    #modes  #successors   successors
   1        1          1           2
   2        2          1           3
   3        1          1           4
   4        1          0
{RULE}
REQUESTS/DURATIONS:
jobnr. mode duration  R 1  N 1
{RULE.replace("*", "-")}
  1      1     0       0    0
  2      1     3       2    5
         2     5       1    2
  3      1     2       1    3
  4      1     0       0    0
{RULE}
RESOURCEAVAILABILITIES:
  R 1  N 1
    2    8
{RULE}
"""


@pytest.fixture(scope="module")
def read(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("files")
    (folder / "toy.sm").write_text(SM)
    (folder / "bad.sm").write_text("nothing")
    (folder / "two.mm").write_text(MM)
    return projects.read_projects(spark, str(folder), "sm"), projects.read_projects(spark, str(folder), "mm")


def test_single_mode(read):
    rows = {r.instance_id: r for r in read[0].withColumn("body", text.structure_text(F.col)).withColumn("h", metrics.horizon(F.col("activities"), F.col("resources"), F.col("precedences"))).collect()}
    g = rows["toy"]
    assert [(a.id, a.duration) for a in g.activities] == [(2, 3), (3, 2), (4, 4), (5, 1)]
    assert [(p.i, p.j, p.relation, p.lag_min, p.lag_max) for p in g.precedences] == [(2, 4, "FS", 0, None), (3, 4, "FS", 0, None), (3, 5, "FS", 0, None)]
    assert (g.RF, g.RS, g.critical_path_length, g.structural_hash, g.difficulty, g.h) == (0.75, 1.0, 7, "40a7954e8cf7bce4", "medium", 10)
    assert g.body.splitlines()[1:3] + g.body.splitlines()[6:9] == ["  R1(renewable,cap=4)", "  R2(renewable,cap=2)", "  T2:3h(2,0)", "  T3:2h(1,1)", "  T4:4h(0,2)"]
    assert g.body.splitlines()[-3:] == ["  T2-[FS,0]->T4", "  T3-[FS,0]->T4", "  T3-[FS,0]->T5"]
    assert rows["bad"].error and rows["bad"].activities is None


def test_multi_mode(read):
    g = read[1].first()
    assert (g.RF, g.RS, g.critical_path_length, g.type) == (1.0, 1.0, 5, "TYPE-B")
    assert [[m.mode_id for m in a.modes] for a in g.activities] == [[1, 2], [1]]
    graph = json.loads(read[1].select(F.to_json(F.struct("type", "activities", "resources", "precedences")).alias("j")).first().j)
    assert least_budget(graph, "NR1") == 5
    cut = {"op": "restrict_modes", "activity_id": 2, "remove_mode_ids": [2]}
    assert spec_reason([cut], graph) is None
    assert spec_reason([{"op": "reduce_nonrenewable_budget", "resource": "NR1", "delta": 4}], graph)
    assert spec_reason([{"op": "reduce_nonrenewable_budget", "resource": "NR1", "delta": 1}], graph) is None
    more = mutate(graph, [{"op": "add_mode", "activity_id": 3, "duration": 1, "renewable_demands": {"R1": 2}, "nonrenewable_demands": {"NR1": 1}}, {"op": "alter_mode_profile", "activity_id": 2, "mode_id": 1, "duration_delta": 2, "demand_deltas": {"R1": -9}}])
    assert more["activities"][1]["modes"][-1]["mode_id"] == 2 and more["activities"][0]["modes"][0]["duration"] == 5 and more["activities"][0]["modes"][0]["renewable_demands"]["R1"] == 0
    assert solve_project(graph)["status"] == "optimal"


def single():
    acts = [{"id": k, "duration": d, "demands": {"R1": 1}} for k, d in ((2, 3), (4, 4))]
    return {"type": "TYPE-C", "activities": acts, "resources": [{"id": "R1", "capacity": 4, "type": "renewable", "downtime": []}], "precedences": [], "objective": {"type": "minimize_makespan"}}


def test_mutations_leave_the_input_and_tighten():
    g = single()
    before = json.dumps(g)
    lag = {"op": "enforce_time_lag", "i": 2, "j": 4, "relation": "FS", "lag_min": 3, "lag_max": 9}
    out = mutate(g, [lag, {**lag, "lag_min": 1, "lag_max": 5}, {"op": "add_precedence", "i": 2, "j": 4}, {"op": "freeze_resource", "resource": "R1", "t_start": 8, "t_end": 9}, {"op": "reduce_capacity", "resource": "R1", "delta": 1, "t_start": 2, "t_end": 4}])
    assert json.dumps(g) == before and len(out["mutations_applied"]) == 5
    assert out["precedences"] == [{"i": 2, "j": 4, "relation": "FS", "lag_min": 3, "lag_max": 5}]
    assert [(w["start"], w["delta"]) for w in out["resources"][0]["downtime"]] == [(2, 1), (8, 4)]
    with pytest.raises(Refused):
        mutate(g, [lag, {**lag, "lag_max": 3}])
    assert mutate(g, [{"op": "alter_objective", "obj_type": "minimize_resource_cost"}])["objective"]["type"] == "minimize_resource_cost"


def test_cycles_and_validation():
    g = single()
    feasible = mutate(g, [{"op": "enforce_time_lag", "i": 2, "j": 4, "relation": "FS", "lag_min": 3, "lag_max": 5}])
    assert plain.cycle_reason(feasible) is None
    both = [{"op": "enforce_time_lag", "i": 2, "j": 4, "relation": "FS", "lag_min": 3}, {"op": "enforce_time_lag", "i": 2, "j": 4, "relation": "SS", "lag_min": 0, "lag_max": 5}]
    assert "positive cycle" in spec_reason(both, g)
    assert "lag_max is not allowed" in spec_reason([both[1]], {**g, "type": "TYPE-A"})
    assert "unknown resource" in spec_reason([{"op": "reduce_capacity", "resource": "R9", "delta": 1, "t_start": 0, "t_end": 1}], g)
    assert form_reason([], "TYPE-A") and form_reason([{"op": "add_mode"}], "TYPE-A") and form_reason([{"op": "freeze_resource"}], "TYPE-A")
    shut = mutate(g, [{"op": "freeze_resource", "resource": "R1", "t_start": 0, "t_end": 50}])
    assert "whole horizon" in after_reason(shut)
    rnd = random.Random(2)
    for _ in range(100):
        edges = [(rnd.randrange(5), rnd.randrange(5)) for _ in range(rnd.randrange(7))]
        weighted = [(i, j, 1) for i, j in edges]
        assert plain.acyclic(list(range(5)), edges) == (graphs.earliest_starts(list(range(5)), weighted) is not None)


def test_hash_goldens(spark):
    a, b = minhash.coefficients()
    assert a[:3] == [2746317214, 478163328, 107420370] and a[127] == 1392783744 and b[:3] == [3332894265, 1354860540, 1149938334] and b[127] == 3997823785
    t1 = "Resource R1 is offline from hour 4 to hour 9 after a coolant failure"
    rows = spark.createDataFrame([(1, t1), (2, "")], "k int, t string")
    s = minhash.with_shingles(rows, "t")
    got = s.select("k", "shingles", minhash.signature_column(F.col("shingles")).alias("sig"), minhash.signature_sql(F.col("shingles"), 5).alias("five")).orderBy("k").collect()
    assert len(got[0].shingles) == 12 and sorted(got[0].shingles)[:2] == [661447, 62598207] and got[1].shingles == [3649838548]
    assert got[0].sig[:3] == [1816546615142923, 316281053676156, 71054031413724] and got[0].five == got[0].sig[:5]
    band = s.where("k = 1").select(F.element_at(minhash.bands(minhash.signature_column(F.col("shingles"))), 1)["bucket"].alias("b")).first().b
    assert band == "d011b13b21714ed381a603a7037cd8a7"
    specs = '[{"op": "reduce_capacity", "resource": "R1"}, {"op": "enforce_time_lag", "i": 2, "j": 4, "relation": "FS"}]'
    from taskloom.schema import SPEC

    assert spark.range(1).select(dedup.exact_key(F.lit("toy_1"), F.from_json(F.lit(specs), f"array<{SPEC}>")).alias("k")).first().k == "cb7b60efdb24efb6"


def test_loss_weight_and_caps(spark):
    rows = spark.createDataFrame([(g, False) for g in (0.0, 0.02, 0.05, 0.10, 0.15, 0.30)] + [(0.1, True)], "g double, a boolean")
    assert [round(r.w, 4) for r in rows.select(metrics.loss_weight(F.col("g"), F.col("a")).alias("w")).collect()] == [1.0, 0.9333, 0.8333, 0.6667, 0.5, 0.5, 0.3]
    caps = spark.createDataFrame([("easy",), ("medium",), ("hard",), ("odd",)], "d string").select(dedup.cell_cap(F.col("d")).alias("c")).collect()
    assert [r.c for r in caps] == [4500, 7500, 3000, 7500]


def test_text_gate(spark):
    body = "CONTEXT: x RESOURCES: R1 TASKS: T1 T2 " + "w " * 60 + "DISRUPTION: " + "d " * 10
    cases = {"": "no words", "w " * 49: "49 words, at least 50 are needed", "w " * 1501: "1501 words, at most 1500 are allowed", body: None, body.replace("T2", ""): "names 1 tasks, at least 2 are needed", body.replace("RESOURCES:", "res"): "no section resources:", body[:-2]: "9 words on the disruption, at least 10 are needed", body.replace("R1", ""): "names no resource", body.replace("T2", "T２"): None}
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(cases)], "k int, t string")
    got = [r.r for r in rows.select("k", gates.text_reason(F.col("t"), F.lit("TYPE-A")).alias("r")).orderBy("k").collect()]
    assert got == list(cases.values())
    assert spark.createDataFrame([(body,)], "t string").select(gates.text_reason(F.col("t"), F.lit("TYPE-B")).alias("r")).first().r == "names no mode of a task"


def test_consistency_gate():
    base, g = single(), mutate(single(), [{"op": "freeze_resource", "resource": "R1", "t_start": 1, "t_end": 2}])
    assert plain.consistency_of(None, g, base)
    assert plain.consistency_of("Resource R1 is offline today.", g, base) is None
    assert plain.consistency_of("R1, offline", g, base)  # no white space after the term
    assert plain.consistency_of("All is well.", g, base)
    assert "does not have" not in (plain.consistency_of("r1 is fine.", base, base) or "")
    assert plain.consistency_of("R1 is offline.", base, base)
    lag = mutate(single(), [{"op": "enforce_time_lag", "i": 2, "j": 4, "relation": "SF", "lag_min": 3}])
    assert plain.consistency_of("T2 and T4 must wait.", lag, base) is None and plain.consistency_of("T2 must wait. T4 too.", lag, base)


def test_solver():
    g = single()
    assert solve_project(g) | {"schedule": None} == {"status": "optimal", "objective": 4.0, "schedule": None, "best_bound": 4.0}
    down = mutate(g, [{"op": "freeze_resource", "resource": "R1", "t_start": 0, "t_end": 2}])
    assert solve_project(down)["objective"] == 6.0 and solve_project(down)["status"] == "feasible"
    assert solve_project({**g, "resources": [{"id": "R1", "capacity": 0, "type": "renewable"}]})["status"] == "infeasible"
    late = {**g, "objective": {"type": "minimize_weighted_tardiness", "task_weights": {"2": 2.0}, "task_deadlines": {"2": 1}}}
    assert solve_project(late)["objective"] == 4.0


def test_mode_search_against_brute_force():
    from itertools import product

    from taskloom.operators.solver import Budget, _within_budgets

    rnd = random.Random(8)
    for _ in range(400):
        caps = [rnd.randint(0, 9) for _ in range(rnd.randint(1, 2))]
        uses = [[[rnd.randint(0, 5) for _ in caps] for _ in range(rnd.randint(1, 3))] for _ in range(rnd.randint(0, 6))]
        fits = [pick for pick in product(*(range(len(o)) for o in uses)) if all(sum(uses[k][m][b] for k, m in enumerate(pick)) <= cap for b, cap in enumerate(caps))]
        got = _within_budgets(uses, caps, Budget(10**6))
        assert (got is None) == (not fits) and (got is None or tuple(got) == fits[0])
    assert _within_budgets([[[1]] * 3] * 40, [39], Budget(100)) is None
    big = {"type": "TYPE-B", "activities": [{"id": k, "modes": [{"mode_id": m + 1, "duration": 2 + m, "renewable_demands": {"R1": 1}, "nonrenewable_demands": {"NR1": 3 - m}} for m in range(3)]} for k in range(9)], "resources": [{"id": "R1", "capacity": 2, "type": "renewable"}, {"id": "NR1", "capacity": 10, "type": "nonrenewable"}], "precedences": []}
    assert solve_project(big)["status"] in ("feasible", "optimal") and solve_project(big) == solve_project(big)
    assert solve_project({**big, "resources": [big["resources"][0], {"id": "NR1", "capacity": 8, "type": "nonrenewable"}]})["status"] == "unknown"


def test_provider_replies(spark):
    reply = spark.createDataFrame([('```json\n{"narrative_sketch": "s", "mutations": [{"op": "freeze_resource", "resource": "R1"}]}\n```',), ("no json",)], "r string")
    got = reply.select(providers.parse_specs(F.col("r")).alias("s")).collect()
    assert got[0].s[0].op == "freeze_resource" and got[1].s is None
    told = spark.createDataFrame([("context: old\nCONTEXT: a b\nDisruption: c d\n",)], "r string").select(text.sections(F.col("r")).alias("s")).first().s
    assert (told.context, told.disruption) == ("a b", "c d")


def test_batch(spark, read, tmp_path):
    ready = read[0].where("error is null").drop("error").unionByName(read[1].drop("error"))
    report = batch.run_batch(spark, ready, str(tmp_path / "out"), copies=2).first()
    records = spark.read.json(str(tmp_path / "out" / "records")) if report.accepted else None
    made = batch.run_gates(spark, ready, copies=2).select("base.instance_id", "expansion", "attempt", "failed_gate").collect()
    assert report.total == len(made) >= report.accepted >= 0
    for key in {(r.instance_id, r.expansion) for r in made}:
        own = sorted((r.attempt, r.failed_gate) for r in made if (r.instance_id, r.expansion) == key)
        assert [a for a, _ in own] == list(range(1, len(own) + 1))
        assert all(g is not None and g < 4 for _, g in own[:-1])
    if records is not None:
        assert records.count() == report.accepted and set(records.columns) >= {"p", "m", "c", "loss_weight", "base_instance_id"}


def test_catalog_takes_all_orders(spark, tmp_path):
    from taskloom.plans import catalog

    for name, key in (("orders", "o_orderkey"), ("lineitem", "l_orderkey")):
        spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").where(f"{key} < 50").coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    n = catalog.project_metrics(spark, str(tmp_path)).count()
    assert catalog.solver_bounds(spark, str(tmp_path)).count() == n > 5
    groups = catalog.batch_report(spark, str(tmp_path)).first()
    assert groups["total"] >= 3 * n


def test_fixed_values():
    assert fixed.SAME_LEAST / fixed.NUM_PERM >= 0.85 > (fixed.SAME_LEAST - 1) / fixed.NUM_PERM


def test_stream(spark, tmp_path):
    from taskloom.streaming.gates import gate_stream

    spark.createDataFrame([(1, "short", "en", "s", 5)], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "in"))
    query = gate_stream(spark, str(tmp_path / "in")).writeStream.format("memory").queryName("gated").option("checkpointLocation", str(tmp_path / "cp")).start()
    query.processAllAvailable()
    query.stop()
    assert spark.table("gated").first().reason == "1 words, at least 50 are needed"


def test_rules_end_at_the_bound(monkeypatch):
    """A schedule that meets the bound ends the search; what the rules share is made once for an assignment of modes."""
    from taskloom.operators import solver

    made, tried = [], []
    init, by = solver._Schedules.__init__, solver._Schedules.by
    monkeypatch.setattr(solver._Schedules, "__init__", lambda self, *a: (made.append(1), init(self, *a))[1])
    monkeypatch.setattr(solver._Schedules, "by", lambda self, rule: (tried.append(rule), by(self, rule))[1])
    acts = [{"id": k, "duration": 10 * k, "demands": {"R1": 1 + k % 2}, "modes": None} for k in (1, 2, 3)]
    model = {"activities": acts, "resources": [{"id": "R1", "capacity": 2, "type": "renewable", "downtime": []}], "precedences": [], "objective": {"type": "minimize_makespan"}}
    assert solver.solve_project(model)["objective"] == 60.0 and len(made) == 1
    tried.clear()
    free = {**model, "activities": [{**a, "demands": {"R1": 0}} for a in acts]}
    assert solver.solve_project(free) == {"status": "optimal", "objective": 30.0, "schedule": {"1": 0, "2": 0, "3": 0}, "best_bound": 30.0} and len(tried) == 1
    odd = {**free, "resources": [{**model["resources"][0], "downtime": [{"start": 0, "end": 9, "delta": -2}]}]}
    tried.clear()
    assert solver.solve_project(odd)["objective"] == 30.0 and len(tried) == 6


def test_signatures_of_texts(spark):
    """The signature made from the text is that of its array of shingles, on odd texts and in both modes."""
    long = " ".join(f"w{k % 700}" for k in range(5000))
    texts = [None, "", " ", "one", "One  two", "a b c", " a\u00a0B\u2003c\td\n", "x x x x x x", "\u0130stanbul \u00c9\u00e9 \u4e2d\u6587 \U0001f600", long]
    rows = spark.createDataFrame(list(enumerate(texts)), "k int, t string").repartition(3)
    for mode in ("compat", "mixed"):
        want = {r.k: r.s for r in minhash.with_shingles(rows, "t").select("k", minhash.signature_column(F.col("shingles"), mode).alias("s")).collect()}
        assert {r.k: r.s for r in rows.select("k", minhash.text_signature(F.col("t"), mode).alias("s")).collect()} == want
