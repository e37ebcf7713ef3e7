"""The data source of project files, and a provider that calls a service."""

import os

import pytest
from pyspark.sql import functions as F

from taskloom.plans import batch
from taskloom.sources import project_files, providers, service
from taskloom.sources.projects import read_projects, with_metrics
from tests.test_projects import MM, SM


def test_project_files(spark, tmp_path):
    for k in range(300):
        (tmp_path / f"j{k:03}.sm").write_text(SM)
    (tmp_path / "deep").mkdir()
    (tmp_path / "deep" / "m1.mm").write_text(MM)
    (tmp_path / "bad.sm").write_text("jobs: no number")
    (tmp_path / "other.txt").write_text("x")
    project_files.register(spark)
    rows = spark.read.format("projects").option("partitionBytes", 400_000).load(str(tmp_path))
    assert rows.rdd.getNumPartitions() <= 5 and rows.count() == 302
    old = read_projects(spark, str(tmp_path), "sm").where("error is null").orderBy("instance_id").limit(3)
    new = with_metrics(rows.where("kind = 'sm' and error is null").drop("file", "kind")).orderBy("instance_id").limit(3)
    assert [r.asDict(True) for r in new.select(old.columns).collect()] == [r.asDict(True) for r in old.collect()]
    assert rows.where("error is not null").select("file").collect()[0].file == "bad.sm"
    some = rows.where((F.col("kind") == "mm") | F.lit(False)).where(F.col("kind") == "mm")
    assert some.rdd.getNumPartitions() == 1 and [r.type for r in some.collect()] == ["TYPE-B"]
    one = rows.where(F.col("file").isin("j007.sm", "j008.sm") & (F.col("type") == "TYPE-A"))
    assert sorted(r.instance_id for r in one.collect()) == ["j007", "j008"]
    reader = project_files.ProjectReader(rows.schema, {"path": str(tmp_path)})
    from pyspark.sql.datasource import EqualTo, GreaterThan

    rest = GreaterThan(("instance_id",), "a")
    assert list(reader.pushFilters([EqualTo(("kind",), "mm"), rest])) == [rest] and sum(len(p.paths) for p in reader.partitions()) == 1
    (tmp_path / "none").mkdir()
    assert spark.read.format("projects").load(str(tmp_path / "none")).count() == 0


def client_of(folder):
    """A service that counts what is paid for; it fails twice, and its process dies once."""

    def make():
        def call(prompt):
            for k in range(2):
                path = os.path.join(folder, f"fail{k}")
                if not os.path.exists(path):
                    open(path, "w").close()
                    raise service.NoReply("busy")
            died = os.path.join(folder, "died")
            if prompt.endswith("7") and not os.path.exists(died):
                open(died, "w").close()
                raise SystemError("worker lost")
            with open(os.path.join(folder, "paid"), "a") as f:
                f.write("x\n")
            return "answer to " + prompt, len(prompt), 3

        return call

    return make


def test_service_pays_once(spark, tmp_path):
    asking = service.Service(client_of(str(tmp_path)), str(tmp_path / "journal"), wait=0.0)
    rows = spark.range(60).select("id", F.when(F.col("id") != 5, F.concat(F.lit("prompt "), F.col("id") % 20)).alias("p")).repartition(3)
    with pytest.raises(Exception, match="worker lost"):
        asking.with_replies(rows, F.col("p"), "reply").collect()
    got = {r.id: r.reply for r in asking.with_replies(rows, F.col("p"), "reply").collect()}
    assert got == {k: None if k == 5 else f"answer to prompt {k % 20}" for k in range(60)}
    assert len(open(tmp_path / "paid").read().split()) == 20
    cost = asking.costs(spark).first()
    assert (cost.calls, cost.tries >= 22, cost.tokens_out) == (20, True, 60) and cost.cost > 0
    again = service.Service(client_of(str(tmp_path / "nowhere")), str(tmp_path / "journal"))
    assert again.with_replies(rows, F.col("p"), "reply").where("reply is not null").count() == 59


def test_batch_with_a_service(spark, tmp_path):
    """The offline provider's replies behind the service's door give the same labels."""
    project_files.register(spark)
    (tmp_path / "a.sm").write_text(SM)
    ready = read_projects(spark, str(tmp_path), "sm").drop("error")

    def make():
        def call(prompt):
            if prompt.startswith("Think"):
                return '{"narrative_sketch": "s", "mutations": [{"op": "freeze_resource", "resource": "R1", "severity": "minor", "position": "early"}]}', 5, 5
            return "CONTEXT: " + "word " * 60 + "\nDISRUPTION: Resource R1 is offline from hour 0 to hour 1, so the day has to be planned anew.", 9, 9

        return call

    asking = service.Service(make, str(tmp_path / "journal"), wait=0.0)
    made = batch.run_gates(spark, ready, asking, copies=1).select("attempt", "failed_gate", "spec_reason", "g0", "g6", "p").collect()
    assert [(r.attempt, r.spec_reason, r.g0, r.g6) for r in made] == [(1, None, None, None)]
    assert asking.costs(spark).first().calls == 2
    assert providers.OfflineProvider() == providers.OfflineProvider()
