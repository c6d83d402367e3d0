"""Headline workloads at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Every workload runs to completion: results are written to the no-op sink, or are the
small tables the operator returns.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

import modeloom as ml  # noqa: E402
from modeloom.operators.dictionary import category_dictionary  # noqa: E402
from modeloom.operators.sampling import hash_sample  # noqa: E402
from modeloom.operators.table import fit_table  # noqa: E402
from modeloom.plans.jobs import encode_chunks  # noqa: E402
from modeloom.plans.staging import staging_path  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEATS = int(os.environ.get("BENCH_REPEATS", "2"))


def session() -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = session()
    spark.sparkContext.setLogLevel("ERROR")
    events = spark.read.parquet(f"{SF_DIR}/events.parquet")
    lineitem = spark.read.parquet(f"{SF_DIR}/lineitem.parquet")
    orders = spark.read.parquet(f"{SF_DIR}/orders.parquet")
    key = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    price = ml.bucket_models(lineitem, ["l_extendedprice"])[0]
    value = ml.bucket_models(events, ["value"])[0]
    encoded = ml.encode_continuous(lineitem, "l_extendedprice", price, key=key)
    spec = {
        "o_totalprice": ml.Continuous(),
        "o_orderpriority": ml.Categorical(),
        "o_orderstatus": ml.Categorical(),
    }
    table = ml.fit_table(orders, spec, key=["o_orderkey"], method="buckets")
    mixed = fit_table(events, {"value": ml.Mixed((0.0,))}, key=["event_id"], method="buckets")
    profile = ml.column_profile(events, ["value"]).first().asDict()

    work = {
        "fit_value_20_iterations": lambda: ml.fit_mixtures(events, ["value"], max_iter=20, tol=0),
        "fit_value_to_convergence": lambda: ml.fit_mixtures(events, ["value"]),
        "fit_two_lineitem_columns_10_iterations": lambda: ml.fit_mixtures(
            lineitem, ["l_extendedprice", "l_quantity"], max_iter=10, tol=0
        ),
        "encode_soft_full": lambda: run(
            ml.encode_continuous(lineitem, "l_extendedprice", price, variant="soft_full")
        ),
        "encode_hard_draw": lambda: run(encoded),
        "encode_hard_argmax": lambda: run(
            ml.encode_continuous(lineitem, "l_extendedprice", price, mode_choice="argmax")
        ),
        "encode_decode": lambda: run(ml.decode_continuous(encoded, price).select("decoded")),
        "roundtrip_report": lambda: ml.roundtrip_report(
            ml.decode_continuous(encoded, price), "l_extendedprice"
        ).collect(),
        "encode_table": lambda: run(table.encode(orders)),
        "decode_table": lambda: run(table.decode(table.encode(orders))),
        "encode_mixed": lambda: run(mixed.encode(events)),
        "encode_chunks": lambda: encode_chunks(
            orders, table, staging_path(spark, "bench"), id_column="o_orderkey", n_chunks=20
        ),
        "column_profile": lambda: ml.column_profile(
            lineitem, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
        ).collect(),
        "quality_report": lambda: ml.quality_report(lineitem, lineitem.columns).collect(),
        "category_dictionary": lambda: category_dictionary(lineitem, ["l_partkey", "l_returnflag"]),
        "encoding_stats": lambda: ml.encoding_stats(
            ml.encode_continuous(events, "value", value, variant="soft_masked")
        ).collect(),
        "hash_sample": lambda: run(hash_sample(lineitem, 0.1, key)),
        "synthesize_1m_rows": lambda: run(ml.synthesize(spark, 1_000_000, profile)),
    }
    seconds = {}
    for name, job in work.items():
        best = None
        for _ in range(REPEATS):
            start = time.perf_counter()
            job()
            took = time.perf_counter() - start
            best = took if best is None else min(best, took)
        seconds[name] = round(best, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total of the best run of each workload",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
