"""Sources of project graphs: benchmark files (.sm single-mode, .mm multi-mode) and projects made of order lines."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import metrics
from ..functions.graphs import critical_path
from ..schema import ACTIVITY, EDGE, OBJECTIVE, RESOURCE, SPEC

PARSED = f"instance_id string, source string, type string, activities array<{ACTIVITY}>, resources array<{RESOURCE}>, precedences array<{EDGE}>, error string"
_RULE = re.compile(r"[*-]+$")


class BadFile(ValueError):
    pass


def header_number(lines: list[str], word: str) -> int:
    for line in lines:
        if word in line.replace(" ", "").lower() and (digits := re.search(r"\d+", line)):
            return int(digits[0])
    raise BadFile(f"no number for {word}")


def block(lines: list[str], title: str) -> list[list[int]]:
    """The numbers of the rows of a section: up to the first rule after its data; titles and column heads are passed over."""
    wanted = title.replace(" ", "").lower()
    begin = next((k for k, line in enumerate(lines) if wanted in line.replace(" ", "").lower()), None)
    if begin is None:
        raise BadFile(f"no section {title}")
    rows = []
    for line in lines[begin + 1 :]:
        text = line.replace(" ", "")
        if text and _RULE.match(text):
            if rows:
                break
        elif text and not re.match(r"[A-Za-z]", text):
            rows.append([int(x) for x in line.split()])
    return rows


def parse_project(text: str, name: str, kind: str) -> dict:
    """A graph without its source and sink; kind: sm or mm. Rows of further modes may leave out the job number."""
    lines = [line.strip() for line in text.splitlines()]
    jobs, n_r = header_number(lines, "jobs"), header_number(lines, "renewable")
    n_n = header_number(lines, "nonrenewable") if kind == "mm" else 0
    ends = {1, jobs}
    edges = [{"i": row[0], "j": j, "relation": "FS", "lag_min": 0, "lag_max": None} for row in block(lines, "PRECEDENCE RELATIONS") if len(row) >= 3 for j in row[3 : 3 + row[2]] if not ends & {row[0], j}]
    kinds, budgets = [f"R{k + 1}" for k in range(n_r)], [f"NR{k + 1}" for k in range(n_n)]
    found: dict[int, list[dict]] = {}
    job = None
    for row in block(lines, "REQUESTS/DURATIONS"):
        if len(row) == 2 + n_r + n_n and kind == "mm":
            row = [job, *row]
        if len(row) < 3 + n_r + n_n:
            continue
        job = row[0]
        uses = row[3:]
        found.setdefault(job, []).append({"mode_id": row[1], "duration": row[2], "renewable_demands": dict(zip(kinds, uses)), "nonrenewable_demands": dict(zip(budgets, uses[n_r:]))})
    amounts = block(lines, "RESOURCEAVAILABILITIES")[0]
    if len(amounts) < n_r + n_n:
        raise BadFile("too few capacities")
    resources = [{"id": k, "capacity": c, "type": "renewable", "downtime": []} for k, c in zip(kinds, amounts)]
    resources += [{"id": k, "capacity": c, "type": "nonrenewable", "downtime": None} for k, c in zip(budgets, amounts[n_r:])]
    if kind == "sm":
        activities = [{"id": j, "duration": m[0]["duration"], "demands": m[0]["renewable_demands"], "modes": None} for j, m in found.items() if j not in ends]
    else:
        activities = [{"id": j, "duration": None, "demands": None, "modes": m} for j, m in found.items() if j not in ends]
    return {"instance_id": name, "source": name, "type": "TYPE-A" if kind == "sm" else "TYPE-B", "activities": activities, "resources": resources, "precedences": edges, "error": None}


def read_projects(spark: SparkSession, folder: str, kind: str = "sm", limit: int | None = None) -> DataFrame:
    """Graphs of the files *.<kind> below folder, with metrics; a file that cannot be read gives a row with `error`."""
    files = spark.read.text(folder, wholetext=True, pathGlobFilter=f"*.{kind}", recursiveFileLookup=True).select("value", F.col("_metadata.file_name").alias("file"))
    if limit is not None:
        files = files.orderBy("file").limit(limit)

    def parse(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = []
            for text, file in zip(part["value"], part["file"]):
                name = file.rsplit(".", 1)[0]
                try:
                    rows.append(parse_project(text, name, kind))
                except (BadFile, ValueError, IndexError, TypeError) as e:
                    rows.append({"instance_id": name, "source": name, "type": None, "activities": None, "resources": None, "precedences": None, "error": str(e) or type(e).__name__})
            yield pd.DataFrame(rows, columns=["instance_id", "source", "type", "activities", "resources", "precedences", "error"])

    return with_metrics(files.mapInPandas(parse, PARSED))


def with_metrics(projects: DataFrame) -> DataFrame:
    """Adds RF, RS, structural hash, critical path, difficulty, objective and the empty mutation log."""
    a, r, p = F.col("activities"), F.col("resources"), F.col("precedences")
    out = projects.withColumns({"RF": metrics.resource_factor(a, r), "RS": metrics.resource_strength(a, r), "structural_hash": metrics.structural_hash(p)})
    path = critical_path(a, p)
    return out.withColumns({
        "critical_path_length": path, "difficulty": F.when(a.isNotNull(), metrics.difficulty(F.col("RF"), F.col("RS"))), "question_type": F.lit(None).cast("string"),
        "split": F.lit("train"), "objective": F.from_json(F.lit('{"type": "minimize_makespan"}'), OBJECTIVE), "mutations_applied": F.array().cast(f"array<{SPEC}>"),
    })


def as_type_c(projects: DataFrame) -> DataFrame:
    """Single-mode projects as projects with maximal lags allowed."""
    return projects.withColumn("type", F.when(F.col("type") == "TYPE-A", "TYPE-C").otherwise(F.col("type")))


#: capacities of the projects made of order lines
CAPACITIES = {"R1": 4, "R2": 3, "R3": 2, "R4": 5}


def activities_of_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each order line: project, id (rank over all columns), duration, resource, demand, lag."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    order = ["l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
    return lines.select(
        F.col("l_orderkey").alias("project"), F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*order)).alias("id"), F.floor("l_quantity").cast("int").alias("duration"),
        F.concat(F.lit("R"), (F.col("l_suppkey") % 4 + 1).cast("string")).alias("resource"), (F.col("l_linenumber") % 3).cast("int").alias("demand"), (F.col("l_partkey") % 5).cast("int").alias("lag"),
    )


def projects_of_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Graphs of all orders: lines are activities, each precedes the next but one with a relation by its number.

    Window and grouping share one shuffle by order.
    """
    acts = activities_of_orders(spark, sf_dir)
    rows = acts.groupBy("project").agg(F.array_sort(F.collect_list(F.struct("id", "duration", "resource", "demand", "lag"))).alias("rows"))
    activity = lambda a: F.struct(a["id"].alias("id"), a["duration"].alias("duration"), F.create_map(a["resource"], a["demand"]).alias("demands"), F.lit(None).cast("array<struct<mode_id:int,duration:int,renewable_demands:map<string,int>,nonrenewable_demands:map<string,int>>>").alias("modes"))
    relation = lambda k: F.when(k % 4 == 0, "SS").when(k % 4 == 2, "FF").otherwise("FS")
    edge = lambda a: F.struct(a["id"].alias("i"), (a["id"] + 2).alias("j"), relation(a["id"]).alias("relation"), a["lag"].alias("lag_min"), F.when(a["id"] % 3 == 0, a["lag"] + a["demand"] * 3 - 1).alias("lag_max"))
    resources = F.array(*(F.struct(F.lit(k).alias("id"), F.lit(v).alias("capacity"), F.lit("renewable").alias("type"), F.array().cast("array<struct<start:int,end:int,delta:int>>").alias("downtime")) for k, v in CAPACITIES.items()))
    out = rows.select(
        F.concat(F.lit("o"), F.col("project").cast("string")).alias("instance_id"), F.lit("orders").alias("source"), F.lit("TYPE-C").alias("type"), F.transform("rows", activity).alias("activities"), resources.alias("resources"),
        F.transform(F.filter("rows", lambda a: a["id"] <= F.size("rows") - 2), edge).alias("precedences"), "project",
    )
    return with_metrics(out)


def projects_of_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Multi-mode graphs of all parts: the order lines of a part with one line number are the modes of an activity, which
    come one after another; NR1 is a budget."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    order = ["l_orderkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
    rows = lines.groupBy("l_partkey", F.col("l_linenumber").cast("int").alias("id")).agg(F.array_sort(F.collect_list(F.struct(*order))).alias("rows"))
    mode = lambda r, k: F.struct((k + 1).alias("mode_id"), F.floor(r["l_quantity"]).cast("int").alias("duration"), F.create_map(F.lit("R1"), (r["l_suppkey"] % 3).cast("int")).alias("renewable_demands"), F.create_map(F.lit("NR1"), (r["l_orderkey"] % 4).cast("int")).alias("nonrenewable_demands"))
    acts = rows.select(F.col("l_partkey").alias("project"), F.struct("id", F.lit(None).cast("int").alias("duration"), F.lit(None).cast("map<string,int>").alias("demands"), F.transform("rows", mode).alias("modes")).alias("a"))
    found = acts.groupBy("project").agg(F.array_sort(F.collect_list("a"), lambda x, y: x["id"] - y["id"]).alias("activities"))
    edge = lambda i, j: F.struct(i["id"].alias("i"), j["id"].alias("j"), F.lit("FS").alias("relation"), F.lit(0).alias("lag_min"), F.lit(None).cast("int").alias("lag_max"))
    n = F.size("activities")
    edges = F.when(n > 1, F.zip_with(F.slice("activities", 1, n - 1), F.slice("activities", 2, n - 1), edge)).otherwise(F.array().cast(f"array<{EDGE}>"))
    resource = lambda name, amount, kind: F.struct(F.lit(name).alias("id"), F.lit(amount).alias("capacity"), F.lit(kind).alias("type"), F.when(F.lit(kind == "renewable"), F.array().cast("array<struct<start:int,end:int,delta:int>>")).alias("downtime"))
    return with_metrics(found.select(
        F.concat(F.lit("p"), F.col("project").cast("string")).alias("instance_id"), F.lit("parts").alias("source"), F.lit("TYPE-B").alias("type"), "activities",
        F.array(resource("R1", 4, "renewable"), resource("NR1", 30, "nonrenewable")).alias("resources"), edges.alias("precedences"), "project",
    ))
