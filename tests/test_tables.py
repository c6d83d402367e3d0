"""Dictionaries, profiles, quality, samples, synthesis, chunks, sinks, streams."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import modeloom as ml
from modeloom.functions.draws import hash_uniform
from modeloom.operators import sampling
from modeloom.operators.order_stats import column_values, order_statistics, value_counts
from modeloom.operators.synth import bracket_probabilities
from modeloom.operators.table import fit_table
from modeloom.plans.jobs import chunk_filter, chunked_job, encode_chunks, ensure_rows
from modeloom.plans.staging import materialise
from modeloom.sources import sinks, tables
from modeloom.streaming.encode_stream import encode_stream, read_parquet_stream
from tests.conftest import SF_DIR


def test_order_statistics_over_many_partitions(spark):
    rng = np.random.default_rng(3)
    x = np.concatenate([np.full(400, 2.5), np.round(rng.exponential(30, 800), 1)])
    y = rng.normal(size=1200)
    df = spark.createDataFrame(list(zip(x.tolist(), y.tolist())), "x double, y double")
    with_parts = materialise(value_counts(df, ["x", "y"]).repartition(6))
    ranks = [1, 2, 399, 400, 401, 777, 1199, 1200]
    found = order_statistics(with_parts, {0: ranks, 1: ranks})
    for c, values in ((0, np.sort(x)), (1, np.sort(y))):
        assert [found[(c, r)] for r in ranks] == [values[r - 1] for r in ranks]


def test_order_statistics_of_odd_numbers(spark):
    values = [-0.0, 0.0, -1e300, 1e-320, -1e-320, 5.0, 5.0, float("nan"), None, float("inf")]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    found = order_statistics(column_values(df, ["x"]), {0: range(0, 12)})
    usable = sorted(v for v in values[:7])
    assert [found[(0, r)] for r in range(1, 8)] == usable and len(found) == 7
    ids = [2**62 + 1, -(2**62), 2**53 + 1, 2**53, -1]
    big = spark.createDataFrame([(v,) for v in ids], "x long")
    found = order_statistics(column_values(big, ["x"], as_type="bigint"), {0: [1, 2, 3, 4, 5]})
    assert [found[(0, r)] for r in range(1, 6)] == sorted(ids)
    assert order_statistics(column_values(df.limit(0), ["x"]), {0: [1]}) == {}


def test_chunk_numbers_are_exact(spark):
    ids = [90071992547409999, 9007199254740991, -1, -1000, -1001, 0, 999, 2**63 - 1, -(2**63)]
    df = spark.createDataFrame([(i,) for i in ids], "id long")
    got = {r["id"]: r["c"] for r in df.select("id", sampling.chunk_by_range("id", 1000).alias("c")).collect()}
    assert got == {i: i // 1000 for i in ids}


def test_draws_of_a_sample_keep_their_distribution(spark):
    df = spark.range(40000).withColumn("value", F.col("id").cast("double"))
    some = sampling.hash_sample(df, 0.1, ["id"])
    for method in ("md5", "xxhash64"):
        mean = some.agg(F.avg(hash_uniform(["id"], 42, method=method))).first()[0]
        assert mean == pytest.approx(0.5, abs=0.03)
    assert some.count() == pytest.approx(4000, rel=0.1)


def test_keys_with_nulls_do_not_collide(spark):
    rows = [("a", None), (None, "a"), ("1:2", "3"), ("1", "2:3"), ("", "a"), ("a", "")]
    df = spark.createDataFrame(rows, "p string, q string")
    draws = [r[0] for r in df.select(hash_uniform(["p", "q"], 1)).collect()]
    assert len(set(draws)) == len(rows)
    with pytest.raises(Exception, match="all parts of the key are NULL"):
        spark.createDataFrame([(None, None)], "p string, q string").select(
            hash_uniform(["p", "q"], 1)
        ).collect()


def test_lookup_reads_the_table_once(spark, tmp_path):
    rows = [(i, f"a{i % 7}", f"b{i % 3}", "new" if i % 2 else f"c{i % 5}") for i in range(400)]
    df = spark.createDataFrame(rows, "id long, a string, b string, c string")
    df.write.parquet(str(tmp_path / "facts"))
    facts = spark.read.parquet(str(tmp_path / "facts"))
    spec = {c: ml.Categorical() for c in ("a", "b", "c")}
    encoder = fit_table(facts.where("c <> 'new'"), spec, key=["id"], unknown="keep")
    decoded = encoder.decode(encoder.encode(facts))
    plan = decoded._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1
    wrong = decoded.where("decoded_a <> a or decoded_b <> b or (c <> 'new' and decoded_c <> c)")
    assert decoded.count() == 400 and wrong.count() == 0
    assert decoded.where("c = 'new' and decoded_c is null").count() == 200
    lean = fit_table(facts, spec, key=["id"], categories="index")
    back = lean.decode(lean.encode(facts))
    assert back.where("decoded_a <> a or decoded_b <> b or decoded_c <> c or size(encoded) <> 3").count() == 0


def test_restart_reads_only_its_ranges(spark, tmp_path):
    spark.range(10000).write.parquet(str(tmp_path / "ids"))
    kept = chunk_filter(spark.read.parquet(str(tmp_path / "ids")), "id", [0, 3], 1000)
    assert kept.count() == 2000
    scan = kept._jdf.queryExecution().sparkPlan().toString()
    assert "PushedFilters: [Or(And(GreaterThanOrEqual(id,0)" in scan


def test_small_percent(spark):
    assert sampling.block_sample(spark.range(100), 0.00001).count() <= 1


def test_reload_keeps_what_is_known_of_the_fit(spark, events, tmp_path):
    encoder = fit_table(events, {"value": ml.Continuous()}, key=["event_id"], max_iter=2, tol=0)
    encoder.save(str(tmp_path / "e"), spark)
    again = type(encoder).load(str(tmp_path / "e"), spark).fitted["value"]
    assert (again.converged, again.iterations) == (False, 2)
    assert again.bounds == encoder.fitted["value"].bounds


def test_profile_equals_numpy(spark, events):
    x = np.array([r["value"] for r in events.collect()])
    row = ml.column_profile(events, ["value"]).first()
    assert row["rows"] == len(x)
    assert row["std"] == pytest.approx(x.std(ddof=1))
    for p in (25, 50, 75, 90, 95, 99):
        assert row[f"p{p}"] == pytest.approx(np.percentile(x, p))
    near = ml.column_profile(events, ["value"], exact=False).first()
    assert near["p50"] == pytest.approx(row["p50"], abs=1)


def test_dictionary_ties_nulls_and_hot_label(spark):
    labels = ["b"] * 5 + ["a"] * 5 + [None] * 3 + ["z"] * 40 + ["c"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(labels)], "id long, v string")
    d = ml.category_dictionary(df, ["v"])
    assert [r["label"] for r in d.table.orderBy("idx").collect()] == ["z", "a", "b", "c"]
    encoded = ml.encode_categorical(df, "v", d)
    assert encoded.where("v is null AND encoded is not null").count() == 0
    back = ml.decode_categorical(encoded, "v", d)
    assert back.where(~F.col("v").eqNullSafe(F.col("decoded"))).count() == 0


def test_unknown_labels(spark):
    seen = spark.createDataFrame([("a",), ("b",), ("a",)], "v string")
    new = spark.createDataFrame([("a",), ("x",), (None,)], "v string")
    d = ml.category_dictionary(seen, ["v"])
    with pytest.raises(Exception, match="not in the dictionary"):
        ml.index_labels(new, "v", d).collect()
    kept = {r["v"]: r["idx"] for r in ml.index_labels(new, "v", d, unknown="keep").collect()}
    assert kept == {"a": 0, "x": 2, None: None}
    assert ml.index_labels(new, "v", d, unknown="skip").count() == 2


def test_large_dictionary_joins_by_shuffle(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    df = spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 40).alias("v")
    )
    d = ml.category_dictionary(df, ["v"])
    assert d.sizes["v"] == 40
    indexed = ml.index_labels(df, "v", d)
    assert indexed.count() == 3000
    assert ml.labels_of(indexed, "idx", d, "v").where("label != v OR label IS NULL").count() == 0
    counts = {r["idx"]: r["count"] for r in indexed.groupBy("idx").count().collect()}
    assert [counts[i] for i in range(40)] == sorted(counts.values(), reverse=True)
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_quality(spark):
    df = spark.createDataFrame(
        [(1.0, "a"), (None, ""), (float("nan"), None), (2.0, "")], "x double, s string"
    )
    rows = {r["col"]: r for r in ml.quality_report(df, ["x", "s", "gone"]).collect()}
    assert tuple(rows["x"])[1:] == (True, 4, 1, 1, 0)
    assert tuple(rows["s"])[1:] == (True, 4, 1, 0, 2)
    assert rows["gone"]["present"] is False and rows["gone"]["nulls"] is None
    assert ml.validate(df, ["x"]) and not ml.validate(df, ["gone"])
    with pytest.raises(ValueError, match="bad values"):
        ml.validate(df, ["x"], strict=True)


def test_samples(spark, events):
    assert sampling.fit_sample(events, ["event_id"]).count() == events.count()
    with pytest.raises(ValueError, match="empty"):
        sampling.fit_sample(events.where("false"), ["event_id"])
    first = sampling.first_rows(events, 37, "event_id")
    assert sorted(r["event_id"] for r in first.collect()) == list(range(37))
    assert sampling.first_rows(events, 10**9, "event_id").count() == events.count()
    part = sampling.range_chunk(events, "event_id", 1, 100)
    assert part.count() == 100
    assert "GreaterThanOrEqual(event_id,100)" in part._jdf.queryExecution().executedPlan().toString()


def test_bracket_probabilities():
    assert bracket_probabilities() == pytest.approx([0.25, 0.5625, 0.16875, 0.0178125, 0.0009375])


def test_synthesis(spark, events, tmp_path):
    profile = ml.column_profile(events, ["value"]).first().asDict()
    made = ml.synthesize(spark, 20000, profile)
    again = ml.column_profile(made, ["amount"]).first()
    assert again["p50"] == pytest.approx(profile["p50"], rel=0.05)
    assert profile["min"] <= again["min"] and again["max"] <= profile["max"]
    old = ml.synthesize(spark, 20000, profile, compat="bracket")
    below = old.where(F.col("amount") < profile["p50"]).count() / 20000
    assert below == pytest.approx(0.25, abs=0.015)
    path = str(tmp_path / "data")
    assert ensure_rows(spark, path, 1003, profile, batch_rows=100) == {"expected": 1003, "written": 1003}
    assert ensure_rows(spark, path, 500, profile) == {"expected": 500, "written": 1003}
    assert tables.read_partitioned(spark, path, "batch=*").select("batch").distinct().count() == 11


def test_chunks_restart(spark, events, tmp_path):
    encoder = fit_table(events, {"value": ml.Continuous()}, key=["event_id"], method="buckets")
    path = str(tmp_path / "out")
    full = encode_chunks(events, encoder, path, id_column="event_id", n_chunks=4)
    before = {tuple(r["encoded"]) for r in full.collect()}
    redone = encode_chunks(
        events, encoder, path, id_column="event_id", n_chunks=4, only=[2], gather=False
    )
    assert redone.count() == events.count()
    assert {tuple(r["encoded"]) for r in redone.collect()} == before
    _, stats = chunked_job(
        events, {"value": ml.Continuous()}, str(tmp_path / "job"), id_column="event_id",
        n_chunks=3, sample_percent=60, method="buckets",
    )
    assert {r["col"]: r["rows"] for r in stats.collect()} == {"value": 1000, "confidence": 1000}


def test_tables_and_merge(spark, events, tmp_path):
    for i in range(3):
        sinks.write_table(events.where(F.col("event_id") % 3 == i), f"stage_{i}")
    sinks.merge_stages(spark, [f"stage_{i}" for i in range(3)], "merged")
    assert tables.read_table(spark, "merged").count() == events.count()
    assert not spark.catalog.tableExists("stage_0")
    sinks.write_parquet(events, str(tmp_path / "p"), partition_by=["event_type"])
    assert tables.read_parquet(spark, str(tmp_path / "p")).count() == events.count()
    events.write.option("header", True).csv(str(tmp_path / "c"))
    schema = "event_id long, value double, event_type string"
    assert tables.read_csv_sample(spark, str(tmp_path / "c"), schema).count() == events.count()
    assert dict(tables.read_csv_sample(spark, str(tmp_path / "c")).dtypes)["value"] == "double"
    spark.sql("DROP TABLE merged")


def test_connector_format_is_a_parameter(spark, events, tmp_path):
    sinks.write_table(events, "any", format="parquet", options={"path": str(tmp_path / "t")})
    assert spark.read.parquet(str(tmp_path / "t")).count() == events.count()


def test_stream_equals_batch(spark, events, tmp_path):
    spec = {"value": ml.Continuous(), "event_type": ml.Categorical()}
    encoder = fit_table(events, spec, key=["event_id"], method="buckets")
    schema = spark.read.parquet(f"{SF_DIR}/events.parquet").schema
    stream = read_parquet_stream(spark, SF_DIR, schema, pattern="events.parquet")
    query = encode_stream(
        stream.select("event_id", "value", "event_type"), encoder,
        str(tmp_path / "out"), str(tmp_path / "state"),
    )
    query.awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).select("event_id", "encoded")
    want = encoder.encode(events).select("event_id", "encoded")
    assert got.exceptAll(want).count() == 0 and got.count() == events.count()


def test_checkpoint_folder_is_the_one_the_session_names(spark):
    from modeloom.plans.staging import checkpoint_folder

    named = spark.conf.get("spark.checkpoint.dir")
    assert named in checkpoint_folder(spark)
