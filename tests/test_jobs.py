"""Counts on the way, samples of whole folders and files, merges that can be run again."""

import pytest
from pyspark.sql import functions as F

import modeloom as ml
from modeloom.operators import sampling
from modeloom.operators.quality import quality_report
from modeloom.plans.jobs import encode_job
from modeloom.sources import sinks


def counter(spark, df):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    return df.mapInArrow(count, df.schema), seen


def test_a_job_that_saves_reads_twice(spark, events, tmp_path, caplog):
    """Once for the fit, once for encoding, writing and counting together."""
    dirty = events.withColumn("value", F.when(F.col("event_id") % 5 > 0, F.col("value")))
    watched, seen = counter(spark, dirty)
    path = str(tmp_path / "out")
    _, _, report = encode_job(
        watched, {"value": ml.Continuous()}, key=["event_id"], max_iter=2,
        save=lambda encoded: sinks.write_parquet(encoded, path),
    )
    assert seen.value == 2 * events.count()
    assert report.collect() == quality_report(dirty, ["value"]).collect()
    assert spark.read.parquet(path).count() == events.count()
    assert "value: 200 null" in caplog.text


def test_an_empty_table_saves_nothing_bad(spark, events, tmp_path):
    path = str(tmp_path / "out")
    _, _, report = encode_job(
        events.limit(0), {"value": ml.Continuous()}, key=["event_id"], fit_on=events, max_iter=2,
        save=lambda encoded: sinks.write_parquet(encoded, path),
    )
    assert [r["rows"] for r in report.collect()] == [0]
    with pytest.raises(ValueError, match="validation failed"):
        encode_job(events, {"absent": ml.Continuous()}, key=["event_id"], save=print)


def test_rows_are_counted_as_they_are_written(spark, events, tmp_path):
    profile = ml.column_profile(events, ["value"]).first().asDict()
    for rows in (0, 1, 1234):
        path = str(tmp_path / f"g{rows}")
        counts = ml.generate_dataset(spark, path, rows, profile)
        assert counts == {"expected": rows, "written": rows}
        if rows:
            assert spark.read.parquet(path).count() == rows


def test_whole_folders_are_sampled_and_pruned(spark, events, tmp_path):
    path = str(tmp_path / "t")
    rows = events.withColumn("chunk", F.col("event_id") % 40)
    sinks.write_parquet(rows.repartition(4, "chunk"), path, partition_by=["chunk"])
    stored = spark.read.parquet(path)
    part = sampling.folder_sample(stored, 30)
    assert part.collect() == sampling.folder_sample(spark.read.parquet(path), 30).collect()
    sizes = {r["chunk"]: r["count"] for r in part.groupBy("chunk").count().collect()}
    assert 3 <= len(sizes) <= 24 and set(sizes.values()) == {25}
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [(CASE WHEN isnull(cast(chunk" in plan
    assert sampling.folder_sample(stored, 100).count() == 1000
    assert sampling.folder_sample(stored, 0).count() == 0


def test_whole_files_are_sampled(spark, events, tmp_path):
    path = str(tmp_path / "t")
    events.repartition(30).write.parquet(path)
    stored = spark.read.parquet(path)
    files = stored.groupBy(F.col("_metadata.file_name").alias("f")).count().collect()
    part = sampling.file_sample(stored, 40, seed=1)
    got = part.groupBy(F.col("_metadata.file_name").alias("f")).count().collect()
    assert set(got) < set(files) and len(got) > 2
    assert part.collect() == sampling.file_sample(spark.read.parquet(path), 40, seed=1).collect()


def stages(spark, events):
    names = [f"again_{i}" for i in range(3)]
    for i, name in enumerate(names):
        sinks.write_table(events.where(F.col("event_id") % 3 == i), name)
    return names


@pytest.mark.parametrize("stop", ["write", "mark", "publish", "drop"])
def test_a_merge_that_was_stopped_is_run_again(spark, events, monkeypatch, stop):
    names = stages(spark, events)
    sql, done = spark.sql, []

    def breaking(text, *args, **options):
        done.append(text)
        if (
            (stop == "write" and "DROP TABLE IF EXISTS out__next" in text)
            or (stop == "mark" and "SET TBLPROPERTIES" in text)
            or (stop == "publish" and "RENAME" in text)
            or (stop == "drop" and "again_1" in text and text.startswith("DROP"))
        ):
            raise RuntimeError("stopped")
        return sql(text, *args, **options)

    monkeypatch.setattr(spark, "sql", breaking)
    with pytest.raises(RuntimeError, match="stopped"):
        sinks.merge_stages(spark, names, "out")
    monkeypatch.undo()
    sinks.merge_stages(spark, names, "out")
    assert spark.read.table("out").exceptAll(events).count() == 0
    assert spark.read.table("out").count() == events.count()
    assert not any(spark.catalog.tableExists(n) for n in [*names, "out__next"])
    # once more changes nothing; other stages that do not exist are an error
    sinks.merge_stages(spark, names, "out")
    assert spark.read.table("out").count() == events.count()
    with pytest.raises(ValueError, match="missing"):
        sinks.merge_stages(spark, ["nowhere"], "out")
    spark.sql("DROP TABLE out")
