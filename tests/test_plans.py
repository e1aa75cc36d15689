import contextlib
import io
import os
import sys

import duckdb
import pytest

from conftest import SF_SMALL
from snapfeed.operators.snapshot import latest_snapshot
from snapfeed.plans import adapters as A

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))

import __spark_entry__ as E  # noqa: E402
from check_oracle import TABLES, canon  # noqa: E402

from snapfeed.plans.catalog import ORACLE, REGISTRY  # noqa: E402

NAMES = sorted(REGISTRY)


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(E.queries())
    missing = [n for n in NAMES if n not in ORACLE]
    assert missing == []


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle_and_has_no_python(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    plan = plan_text(df)
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    got = df.toPandas()
    want = duck.execute(E.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert canon(got) == canon(want)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "dup_count" in df.columns


def test_latest_snapshot_prunes_partitions(spark, tmp_dir):
    path = os.path.join(tmp_dir, "hist")
    A.fills(spark, SF_SMALL).write.partitionBy("_snapshot_date").parquet(path)
    df = latest_snapshot(spark.read.parquet(path))
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    plan = buf.getvalue()
    assert "PartitionFilters: [isnotnull(_snapshot_date" in plan and "= Subquery subquery" in plan
    assert df.count() == A.fills(spark, SF_SMALL).where("_snapshot_date = DATE'2024-01-21'").count()


def formatted(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_refill_shuffle_splits_hot_patients(spark):
    plan = formatted(E.queries()["refill_number"](spark, SF_SMALL))
    windows_keys = [line for line in plan.splitlines() if "hashpartitioning(" in line and "__b" in line]
    assert windows_keys, "rows must be shuffled on (patient, bucket), not on the patient alone"


def test_dedup_pre_aggregates_map_side(spark):
    plan = formatted(E.queries()["dedup_latest"](spark, SF_SMALL))
    assert "partial_max_by" in plan and "partial_count" in plan


def test_rx_merge_reuses_dedup_partitioning(spark):
    plan = formatted(E.queries()["rx_upsert"](spark, SF_SMALL))
    tree = plan.split("\n\n\n")[0]
    lines = tree.splitlines()
    join = next(i for i, line in enumerate(lines) if "SortMergeJoin FullOuter" in line)
    # Directly below the join: the aggregates, with no Exchange between.
    below = [line.strip(" :+-") for line in lines[join + 1:join + 3]]
    assert all("Exchange" not in b for b in below), below


def test_hot_key_results_are_whole(spark):
    from pyspark.sql import functions as F
    from snapfeed.operators.windows import dedup_latest, number_within_group
    hot = spark.range(0, 30000).select(F.lit(1).alias("k"), F.col("id").alias("o"))
    rest = spark.range(30000, 90000).select((F.col("id") % 997 + 2).alias("k"), F.col("id").alias("o"))
    df = hot.unionByName(rest)
    d = dedup_latest(df, ["k"], ["o desc"], count_col="n")
    assert d.where("k = 1").select("o", "n").first() == (29999, 30000)
    assert d.agg(F.sum("n")).first()[0] == 90000
    seq = number_within_group(df, ["k"], "o", bucket_bits=10)
    hot_seq = seq.where("k = 1").agg(F.min("seq"), F.max("seq"), F.countDistinct("seq")).first()
    assert tuple(hot_seq) == (1, 30000, 30000)
