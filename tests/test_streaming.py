import pytest

from sparkdraft.operators.checks import CheckFailed
from sparkdraft.streaming import ledger
from sparkdraft.streaming.ingest import IncrementalTable, ingest_files

DDL = "k bigint, v string"


def write(spark, rows, path):
    spark.createDataFrame(rows, DDL).coalesce(1).write.mode("append").parquet(str(path))


def test_increments_are_idempotent(spark, tmp_path):
    source, root = tmp_path / "in", tmp_path / "out"
    table = IncrementalTable(spark, f"{root}/t", DDL, ["k"])

    def run(name="s"):
        ingest_files(spark, str(source), DDL, table, f"{root}/{name}", name=name)
        return {(r.k, r.v) for r in table.rows().collect()}, table.rows().count()

    write(spark, [(1, "a"), (2, "b"), (2, "b")], source)
    assert run() == ({(1, "a"), (2, "b")}, 2)
    assert run() == ({(1, "a"), (2, "b")}, 2)  # nothing new
    write(spark, [(2, "b"), (3, "c")], source)  # overlaps the first file
    assert run() == ({(1, "a"), (2, "b"), (3, "c")}, 3)
    assert run("again")[1] == 3  # another stream over the same files adds nothing
    table.write_batch(spark.createDataFrame([(3, "c"), (4, "d")], DDL), "x", 0)
    table.write_batch(spark.createDataFrame([(3, "c"), (4, "d")], DDL), "x", 0)  # a retried batch
    assert table.rows().count() == 4
    with pytest.raises(CheckFailed):
        table.write_batch(spark.createDataFrame([(1, "other")], DDL), "x", 1)


def test_a_batch_reads_only_its_buckets(spark, tmp_path):
    table = IncrementalTable(spark, str(tmp_path / "t"), DDL, ["k"], buckets=8)
    table.write_batch(spark.range(200).selectExpr("id AS k", "'x' AS v"), "s", 0)
    files = table.rows().inputFiles()
    assert len({f.split("bucket=")[1].split("/")[0] for f in files}) == 8
    some = table.rows(buckets=[3])
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "(bucket" in plan.split("PartitionFilters: [")[1][:80]
    assert 0 < some.count() < 60
    with pytest.raises(CheckFailed, match="differs from stored rows.*: 1"):
        table.write_batch(spark.createDataFrame([(7, "y"), (500, "x")], DDL), "s", 1)
    with pytest.raises(CheckFailed, match="one key with different rows.*: 1"):
        table.write_batch(spark.createDataFrame([(700, "y"), (700, "x")], DDL), "s", 1)
    assert table.rows().count() == 200  # nothing of a refused batch is there
    table.write_batch(spark.createDataFrame([(7, "x"), (500, "x")], DDL), "s", 1)
    assert table.rows().count() == 201


def test_progress(spark):
    progress = spark.createDataFrame([("d1", 2, 0, False), ("d2", 1, 0, False)],
                                     "draft_id string, expected bigint, processed bigint, completed boolean")
    batch = spark.createDataFrame([("d1",), ("d2",), ("d2",)], "draft_id string")
    after = ledger.merge_progress(progress, batch)
    assert {tuple(r) for r in after.collect()} == {("d1", 2, 1, False), ("d2", 1, 2, False)}
    assert [r.draft_id for r in ledger.overfull(after).collect()] == ["d2"]
