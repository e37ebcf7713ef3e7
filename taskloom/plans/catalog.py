"""Named queries over the driver tables, each with the SQL that states the same where SQL can."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import codegen, fixed, gates, metrics, minhash, text
from ..functions.graphs import cycle_reason
from ..operators import dedup, graph_sets
from ..operators.ordered import accept_in_order
from ..operators.mutations import resolve_severity
from ..operators.solver import solution
from ..operators.validation import validated_mutation
from ..schema import ACTIVITY, EDGE, SPEC, WINDOW
from ..sources.projects import activities_of_orders, projects_of_orders, projects_of_parts
from ..sources.providers import call_cost
from ..sources.staging import staged
from . import batch
from .oracle import ORACLE_SQL

FLAGSHIP = "gate0_report"


def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def gate0_prefilter(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", gates.text_reason(F.col("text"), F.lit("TYPE-A")).alias("reason"))


def gate0_report(spark, sf_dir):
    reason = F.regexp_replace(F.coalesce(gates.text_reason(F.col("text"), F.lit("TYPE-A")), F.lit("pass")), r"\d+ words, ", "")
    return documents(spark, sf_dir).select(reason.alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


def project_metrics(spark, sf_dir):
    g = projects_of_orders(spark, sf_dir)
    return g.select("project", F.round("RF", 9).alias("rf"), F.round("RS", 9).alias("rs"), F.round(metrics.network_density(F.col("activities"), F.col("precedences")), 9).alias("density"), "difficulty")


def structural_hash(spark, sf_dir):
    return projects_of_orders(spark, sf_dir).select("project", "structural_hash")


def difficulty_hist(spark, sf_dir):
    return projects_of_orders(spark, sf_dir).groupBy("difficulty").agg(F.count("*").alias("n"))


def critical_path(spark, sf_dir):
    return projects_of_orders(spark, sf_dir).select("project", F.col("critical_path_length").cast("long").alias("critical_path_length"))


def horizon(spark, sf_dir):
    return projects_of_orders(spark, sf_dir).select("project", metrics.horizon(F.col("activities"), F.col("resources"), F.col("precedences")).cast("long").alias("horizon"))


def distance_edges(spark, sf_dir):
    """Edges of the distance graph relationally: explode, look both durations up, forward and backward weights."""
    g = projects_of_orders(spark, sf_dir)
    d = F.map_from_entries(F.transform("activities", lambda a: F.struct(a["id"], a["duration"])))
    e = g.select("project", d.alias("d"), F.explode("precedences").alias("p")).select("project", "p.*", F.element_at("d", F.col("p.i")).alias("di"), F.element_at("d", F.col("p.j")).alias("dj"))
    lo, hi, di, dj, kind = F.col("lag_min"), F.col("lag_max"), F.col("di"), F.col("dj"), F.col("relation")
    forward = F.when(kind == "FS", di + lo).when(kind == "SS", lo).when(kind == "FF", di - dj + lo).when(kind == "SF", lo - dj)
    backward = F.when(kind == "FS", -(di + hi)).when(kind == "SS", -hi).when(kind == "FF", dj - di - hi).when(kind == "SF", dj - hi)
    there = e.select("project", F.col("i").alias("source"), F.col("j").alias("target"), forward.alias("weight"))
    back = e.where("lag_max is not null").select("project", F.col("j").alias("source"), F.col("i").alias("target"), backward.alias("weight"))
    return there.unionAll(back)


def cycle_flags(spark, sf_dir):
    return projects_of_orders(spark, sf_dir).select("project", cycle_reason(F.col("activities"), F.col("precedences")).isNotNull().alias("infeasible"))


def structure_text(spark, sf_dir):
    return projects_of_orders(spark, sf_dir).select("project", text.structure_text(F.col).alias("body"))


def graph_summary(spark, sf_dir):
    return projects_of_orders(spark, sf_dir).select("project", text.graph_summary(F.col).alias("body"))


def generated_program(spark, sf_dir):
    """The stand-alone program of every project, all nine sections."""
    return projects_of_orders(spark, sf_dir).select("project", codegen.program(F.col).alias("c"))


def code_syntax(spark, sf_dir):
    """Gate 2 on programs of which every third has lost its last bracket."""
    cut = F.when(F.col("project") % 3 == 0, F.regexp_replace("c", r"\)\s*$", "")).otherwise(F.col("c"))
    g = generated_program(spark, sf_dir).withColumn("c", cut)
    return g.select("project", gates.syntax_reason(F.col("c")).isNull().alias("compiles"))


def gate1_structural(spark, sf_dir):
    return projects_of_orders(spark, sf_dir).select("project", gates.structure_reason(F.col).alias("reason"))


def _first_specs(g):
    """A downtime on the resource of the first activity, its severity by the project number."""
    level = F.element_at(F.array(*(F.lit(x) for x in fixed.LEVELS)), (F.col("project") % 4 + 1).cast("int"))
    spec = F.struct(F.lit("reduce_capacity").alias("op"), F.element_at(F.map_keys(F.element_at("activities", 1)["demands"]), 1).alias("resource"), level.alias("severity"), F.lit("mid").alias("position"))
    made = F.from_json(F.to_json(F.array(spec)), f"array<{SPEC}>")
    return g.withColumn("specs", F.transform(made, lambda m: resolve_severity(m, F.col("resources"), F.col("critical_path_length"), F.col("project"))))


def severity_numbers(spark, sf_dir):
    s = _first_specs(projects_of_orders(spark, sf_dir)).select("project", F.element_at("specs", 1).alias("s"))
    return s.select("project", "s.resource", "s.severity", "s.delta", (F.col("s.t_end") - F.col("s.t_start")).alias("length"), "s.t_start")


#: what mutations and their rules look at; the metrics of a graph pass through unread
MUTATED = ("type", "activities", "resources", "precedences", "objective", "mutations_applied")


def mutation_apply(spark, sf_dir):
    """Graphs after their downtime, or why it is refused: windows and length of the log."""
    g = _first_specs(projects_of_orders(spark, sf_dir))
    done = g.select("project", validated_mutation(F.struct(*MUTATED), F.col("specs")).alias("made"))
    windows = F.aggregate("made.graph.resources", F.lit(0), lambda n, r: n + F.size(r["downtime"]))
    return done.select("project", F.col("made.reason").alias("reason"), windows.alias("n_windows"), F.size("made.graph.mutations_applied").alias("n_mutations"))


def shingle_counts(spark, sf_dir):
    return minhash.with_shingles(documents(spark, sf_dir), "text").select("doc_id", F.size("shingles").cast("long").alias("n_shingles"))


def minhash_signature(spark, sf_dir):
    """First four of the 128 positions."""
    s = dedup.signatures(documents(spark, sf_dir), "doc_id", "text")
    return s.select("doc_id", *(F.element_at("signature", k + 1).alias(f"p{k}") for k in range(4)))


def minhash_bands(spark, sf_dir):
    s = dedup.signatures(documents(spark, sf_dir), "doc_id", "text")
    return s.select("doc_id", F.explode(minhash.bands(F.col("signature"))).alias("b")).select("doc_id", "b.band", "b.bucket")


def lsh_pairs(spark, sf_dir):
    return dedup.similar_pairs(staged(dedup.signatures(documents(spark, sf_dir), "doc_id", "text")), "doc_id")


def greedy_dedup(spark, sf_dir):
    """Ordered acceptance of documents by text alone (cells without a cap that binds)."""
    d = documents(spark, sf_dir)
    signed = staged(dedup.signatures(d, "doc_id", "text").withColumn("class", dedup.signature_class(F.col("signature"))), "signed")
    links = dedup.similar_pairs(signed.select("class", "signature").distinct(), "class").toDF("earlier", "later", "same")
    rows = d.select(F.col("doc_id").alias("seq"), F.sha2("text", 256).alias("hash"), F.col("lang").alias("cell"), F.lit(1 << 30).alias("cap"), F.col("doc_id").cast("string").alias("base_id"), F.lit("train").alias("split"))
    return accept_in_order(rows.join(signed.select(F.col("doc_id").alias("seq"), "class"), "seq"), links).select("seq", "accepted")


def exact_keys(spark, sf_dir):
    g = _first_specs(projects_of_orders(spark, sf_dir))
    return g.select("project", dedup.exact_key(F.col("instance_id"), F.col("specs")).alias("key"))


def quota_hold(spark, sf_dir):
    """Documents by cell (lang, source) in order of doc_id; a cell takes twenty."""
    out = dedup.quota_reason(documents(spark, sf_dir).select("doc_id", "lang", "source"), ["lang", "source"], "doc_id", F.lit(20))
    return out.select("doc_id", F.concat_ws("::", "lang", "source").alias("cell"), "n_before", "held")


def split_leaks(spark, sf_dir):
    """Order lines whose part is already in another split (by parity of the order) than that of its first line."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_partkey", F.when(F.col("l_orderkey") % 10 < 7, "train").otherwise("test").alias("split"))
    return lines.groupBy("l_partkey").agg(F.count_distinct("split").alias("n_splits")).groupBy("n_splits").agg(F.count("*").alias("n"))


def stratified_split(spark, sf_dir):
    return dedup.stratified_split(documents(spark, sf_dir).select("doc_id", "lang"), "lang", "doc_id").select("doc_id", "split")


def split_counts(spark, sf_dir):
    return stratified_split(spark, sf_dir).groupBy("split").agg(F.count("*").alias("n"))


def expansion(spark, sf_dir):
    return dedup.expand(stratified_split(spark, sf_dir), "doc_id", 3).select("doc_id", "split", "expansion", "question_type")


def mode_requests(spark, sf_dir):
    """Request rows grouped into the modes of a job, in the order of their number."""
    acts = activities_of_orders(spark, sf_dir)
    modes = acts.groupBy("project", "resource").agg(F.array_sort(F.collect_list(F.struct("id", "duration"))).alias("m"))
    return modes.select("project", "resource", F.size("m").alias("n_modes"), F.array_min(F.transform("m", lambda x: x["duration"])).alias("least_duration"), F.element_at("m", 1)["duration"].alias("first_duration"))


def gap_loss_weight(spark, sf_dir):
    """Gap, approximation flag and loss weight from prices: the discounted price stands for the bound."""
    l = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_partkey", "l_linenumber", F.col("l_extendedprice").alias("value"), (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("bound"), F.when(F.col("l_returnflag") == "N", "optimal").otherwise("feasible").alias("status"))
    gap = metrics.gap_of(F.col("status"), F.col("value"), F.col("bound"))
    l = l.withColumn("gap", gap).withColumn("approx", (F.col("status") == "feasible") & (F.col("gap") > 0.05))
    return l.select("l_orderkey", "l_partkey", "l_linenumber", F.round("gap", 6).alias("gap"), "approx", F.round(metrics.loss_weight(F.col("gap"), F.col("approx")), 6).alias("loss_weight"))


def solver_bounds(spark, sf_dir):
    """Schedules of the projects of all orders."""
    s = projects_of_orders(spark, sf_dir).select("project", solution(text.target_model(F.col)).alias("s"))
    return s.select("project", "s.status", "s.objective", "s.best_bound")


def first_failure(spark, sf_dir):
    """Per order, the first failing line and its reason: the least position with a reason."""
    acts = activities_of_orders(spark, sf_dir)
    reason = F.when(F.col("demand") == 0, "no demand").when(F.col("duration") > 40, "too long")
    bad = acts.withColumn("reason", reason).where("reason is not null")
    return bad.groupBy("project").agg(F.min("id").alias("first_id"), F.min_by("reason", "id").alias("reason"))


def resource_join(spark, sf_dir):
    """Activities joined with resources by id, and those without: here R4 is withheld."""
    acts = activities_of_orders(spark, sf_dir)
    kinds = spark.createDataFrame([(k, v) for k, v in {"R1": 4, "R2": 3, "R3": 2}.items()], "rid string, capacity int")
    joined = acts.join(F.broadcast(kinds), F.col("resource") == F.col("rid"), "left")  # three rows, fixed
    return joined.groupBy("resource").agg(F.count("*").alias("n"), F.count("rid").alias("n_known"), F.coalesce(F.sum(F.when(F.col("demand") > F.col("capacity"), 1)), F.lit(0)).cast("long").alias("n_over"))


def batch_stats(spark, sf_dir):
    """Counts, cost and rate by status, as of a finished batch: orders stand for instances."""
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    n = F.count("*")
    return o.groupBy("o_orderpriority").agg(
        n.alias("total"), F.count_if(F.col("o_orderstatus") == "F").alias("accepted"), F.count_if(F.col("o_orderstatus") == "O").alias("rejected"),
        F.round(F.count_if(F.col("o_orderstatus") == "F") / n, 4).alias("acceptance_rate"), F.round(F.sum(F.col("o_totalprice").cast("decimal(18,2)")), 2).cast("double").alias("cost"),
    )


def call_costs(spark, sf_dir):
    """Token cost of conversations as a call log: prompt words in, reply words out, by role."""
    words = F.size(F.expr("filter(split(text, ' '), w -> w <> '')"))
    c = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "role", words.alias("n"))
    calls = c.groupBy("conv_id").agg(F.sum(F.when(F.col("role") == "user", F.col("n")).otherwise(0)).alias("tokens_in"), F.sum(F.when(F.col("role") == "assistant", F.col("n")).otherwise(0)).alias("tokens_out"))
    return calls.withColumn("cost", F.round(call_cost(F.col("tokens_in"), F.col("tokens_out")), 8))


def quota_caps(spark, sf_dir):
    """Accepted rows by cell against its cap, counting in order: rows of each order priority and status."""
    o = spark.read.parquet(f"{sf_dir}/orders.parquet").withColumn("level", F.when(F.col("o_orderstatus") == "F", "easy").when(F.col("o_orderstatus") == "O", "medium").otherwise("hard"))
    held = dedup.quota_reason(o.select("o_orderpriority", "level", "o_orderkey"), ["o_orderpriority", "level"], "o_orderkey", dedup.cell_cap(F.col("level"), 1000))
    return held.groupBy("o_orderpriority", "level").agg(F.count("*").alias("n"), F.count_if("held").alias("n_held"))


def batch_report(spark, sf_dir):
    """The whole chain on the projects of all orders: labels of all attempts, as a report with costs."""
    counters = batch.Counters()
    labelled = batch.run_gates(spark, projects_of_orders(spark, sf_dir), target=1000, counters=counters)
    out = batch.with_costs(batch.report(labelled), counters)
    return out.withColumns({"failures_by_gate": F.to_json("failures_by_gate"), "accepted_by_cell": F.to_json("accepted_by_cell")})


def gate0_rules(spark, sf_dir):
    """Documents dressed as problem texts, each in one of eleven ways, most with a part missing."""
    v = F.col("doc_id") % 11
    unless = lambda k, c, other="": F.when(v != k, c).otherwise(other)
    tasks = F.when(v == 6, "T1").when(v == 7, "T1-M1, T2-M1").otherwise("T1, T2")
    stops = F.repeat(F.lit("stop "), F.when(v == 9, F.col("doc_id") % 10).otherwise(12).cast("int"))
    gap = F.lit("\n\n")
    body = F.concat(unless(1, "CONTEXT: "), F.coalesce("text", F.lit("")), gap, unless(2, "RESOURCES: "), unless(4, "R1(cap=4)"), gap, unless(5, "TASKS: "), tasks, gap, F.when(v == 8, "").otherwise("DISRUPTION: "), stops)
    return documents(spark, sf_dir).select("doc_id", gates.text_reason(body, F.when(v == 3, "TYPE-B").otherwise("TYPE-A")).alias("reason"))


def gate6_evidence(spark, sf_dir):
    """Documents that tell, or do not tell, of what is planted in their model, in eight ways."""
    v = F.col("doc_id") % 8
    near = F.concat(F.lit("R1 "), F.repeat(F.lit("w "), (F.col("doc_id") % 14).cast("int")), F.lit("offline."))
    told = F.coalesce(*(F.when(v.isin(*k), t) for k, t in (
        ((0, 1), near), ((2,), F.lit("Between T1 and T2 a waiting period holds.")), ((3,), F.lit("T1 comes first. A waiting period holds for T2.")), ((4,), F.lit("Now R2 is offline.")),
        ((5,), F.lit("Every day late has its penalty.")), ((6,), F.lit("The plan has another aim.")),
    )))
    p = F.concat(F.coalesce("text", F.lit("")), F.coalesce(F.concat(F.lit("\n\nDISRUPTION: "), told), F.lit("")))
    window = F.when(v < 2, F.array(F.struct(F.lit(1).alias("start"), F.lit(2).alias("end"), F.lit(1).alias("delta")))).otherwise(F.array().cast(f"array<{WINDOW}>"))
    resource = lambda name, w: F.struct(F.lit(name).alias("id"), F.lit(4).alias("capacity"), F.lit(None).cast("string").alias("type"), w.alias("downtime"))
    edge = F.when(v.isin(2, 3), F.array(F.struct(F.lit(1).alias("i"), F.lit(2).alias("j"), F.lit("FS").alias("relation"), F.lit(3).alias("lag_min"), F.lit(None).cast("int").alias("lag_max")))).otherwise(F.array().cast(f"array<{EDGE}>"))
    aim = F.when(v.isin(5, 6), "minimize_weighted_tardiness").otherwise("minimize_makespan")
    acts = F.array().cast(f"array<{ACTIVITY}>")
    model = F.struct(acts.alias("activities"), F.array(resource("R1", window), resource("R2", F.array().cast(f"array<{WINDOW}>"))).alias("resources"), edge.alias("precedences"), F.struct(aim.alias("type")).alias("objective"))
    base = F.struct(acts.alias("activities"), F.array().cast(f"array<{EDGE}>").alias("precedences"))
    return documents(spark, sf_dir).select("doc_id", gates.consistency_reason(p, model, base).alias("reason"))


def _one_spec(**fields):
    """An array of one spec with these columns, the others null."""
    made = F.struct(*(v.alias(k) for k, v in fields.items()))
    return F.from_json(F.to_json(F.array(made)), f"array<{SPEC}>")


def _mutated(g, ops, measures):
    """Projects with one mutation each, by project % 5: why it is refused, or a number that it changes."""
    v = F.col("project") % len(ops)
    specs = F.coalesce(*(F.when(v == k, _one_spec(op=F.lit(op), **fields)) for k, (op, fields) in enumerate(ops)))
    done = g.select("project", F.get(F.array(*(F.lit(op) for op, _ in ops)), v.cast("int")).alias("op"), validated_mutation(F.struct(*MUTATED), specs).alias("made"))
    done = staged(done, "mutated")
    measure = F.coalesce(*(F.when(v == k, m(F.col("made.graph"))) for k, m in enumerate(measures)))
    return done.select("project", "op", "made.reason", F.when(F.col("made.reason").isNull(), measure).cast("long").alias("measure"))


def mutations_single(spark, sf_dir):
    k, lit = F.col("project"), F.lit
    ops = (
        ("reduce_capacity", {"resource": lit("R1"), "delta": k % 6, "t_start": lit(2), "t_end": 2 + k % 7}), ("freeze_resource", {"resource": lit("R2"), "delta": lit(3), "t_start": lit(0), "t_end": k % 150 + 1}),
        ("enforce_time_lag", {"i": lit(1), "j": lit(3), "relation": lit("FS"), "lag_min": k % 9}), ("add_precedence", {"i": lit(1), "j": lit(2)}), ("alter_objective", {"obj_type": lit("minimize_resource_cost")}),
    )
    shut = lambda g: F.aggregate(F.flatten(F.transform(g["resources"], lambda r: r["downtime"])), lit(0), lambda n, w: n + w["delta"] * (w["end"] - w["start"]))
    lags = lambda g: F.aggregate(g["precedences"], lit(0), lambda n, p: n + p["lag_min"])
    return _mutated(projects_of_orders(spark, sf_dir), ops, (shut, shut, lags, lambda g: F.size(g["precedences"]), lambda g: (g["objective"]["type"] == "minimize_resource_cost").cast("int")))


def mutations_multi(spark, sf_dir):
    k, lit = F.col("project"), F.lit
    first = F.element_at("activities", 1)["id"]
    ops = (
        ("alter_mode_profile", {"activity_id": first, "mode_id": lit(1), "duration_delta": k % 7 - 3}), ("restrict_modes", {"activity_id": first, "remove_mode_ids": F.array(lit(1))}),
        ("add_mode", {"activity_id": first, "duration": k % 4, "renewable_demands": F.create_map(lit("R1"), lit(1))}), ("reduce_nonrenewable_budget", {"resource": lit("NR1"), "delta": k % 33}),
        ("alter_objective", {"obj_type": F.when(k % 2 == 1, "minimize_weighted_tardiness").otherwise("maximize_robustness_margin")}),
    )
    modes = lambda g: F.aggregate(g["activities"], lit(0), lambda n, a: n + F.size(a["modes"]))
    changed = lambda g: F.element_at(F.element_at(g["activities"], 1)["modes"], 1)["duration"]
    budget = lambda g: F.element_at(g["resources"], 2)["capacity"]
    return _mutated(projects_of_parts(spark, sf_dir), ops, (changed, modes, modes, budget, lambda g: (g["objective"]["type"] == "maximize_robustness_margin").cast("int")))


def ring_cycles(spark, sf_dir):
    """Rings of the lines of every order of three or more, by all four relations, closed by a negative lag."""
    size = F.count("*").over(Window.partitionBy("project"))
    rows = staged(activities_of_orders(spark, sf_dir).select("project", "id", "duration", "lag", size.alias("size")), "ring")
    relation = F.get(F.array(*(F.lit(r) for r in fixed.RELATIONS)), F.col("id") % 4)
    lag = F.when(F.col("id") == F.col("size"), -(F.col("project") % 7) * 20).otherwise(F.col("lag"))
    edges = rows.where("size >= 3").select("project", F.col("id").alias("i"), (F.col("id") % F.col("size") + 1).alias("j"), relation.alias("relation"), lag.alias("lag_min"), F.lit(None).cast("int").alias("lag_max"))
    days = rows.select("project", "id", "duration")
    return graph_sets.infeasible_graphs(days, edges, "project")


def branching_paths(spark, sf_dir):
    """Critical paths of the lines of every order, joined by steps of one, two and five."""
    acts = staged(activities_of_orders(spark, sf_dir).select("project", "id", "duration"), "acts")
    steps = F.array_compact(F.array(F.lit(2), F.when(F.col("id") % 3 != 0, 1), F.when(F.col("id") == 1, 5)))
    edges = acts.select("project", F.col("id").alias("i"), F.explode(F.transform(steps, lambda s: F.col("id") + s)).alias("j"))
    return graph_sets.critical_paths(acts, edges, "project")


_ALL = (
    gate0_rules, gate6_evidence, mutations_single, mutations_multi, ring_cycles, branching_paths,
    gate0_prefilter, gate0_report, project_metrics, structural_hash, difficulty_hist, critical_path, horizon, distance_edges, cycle_flags, structure_text, graph_summary, generated_program, code_syntax,
    gate1_structural, severity_numbers, mutation_apply, shingle_counts, minhash_signature, minhash_bands, lsh_pairs, greedy_dedup, exact_keys, quota_hold, split_leaks, stratified_split, split_counts,
    expansion, mode_requests, gap_loss_weight, solver_bounds, first_failure, resource_join, batch_stats, call_costs, quota_caps, batch_report,
)
QUERIES = {f.__name__: f for f in _ALL}


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(ORACLE_SQL)
