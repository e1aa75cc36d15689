import pytest
from pyspark.sql import functions as F

from snapfeed.operators.merge import merge_counts, merge_upsert


def _key(r):
    return tuple((v is None, "" if v is None else v) for v in r)


def content(df):
    return sorted((tuple(r) for r in df.collect()), key=_key)


@pytest.fixture()
def tables(spark):
    t = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (None, "n", 9.0), (4, "d", 4.0)], "k int, v string, x double")
    s = spark.createDataFrame([(2, "B"), (3, "C"), (None, "N")], "k int, v string")
    return t, s


def test_merge_semantics(tables):
    t, s = tables
    m = merge_upsert(t, s, ["k"])
    assert content(m) == sorted([(1, "a", 1.0), (2, "B", 2.0), (None, "n", 9.0), (4, "d", 4.0),
                                 (3, "C", None), (None, "N", None)], key=_key)


def test_merge_row_count_and_idempotent(tables):
    t, s = tables
    m = merge_upsert(t, s, ["k"])
    anti = s.where(F.col("k").isNull()).count() + s.join(t, "k", "left_anti").where(F.col("k").isNotNull()).count()
    assert m.count() == t.count() + anti
    non_null_s = s.where(F.col("k").isNotNull())
    once = merge_upsert(t, non_null_s, ["k"])
    twice = merge_upsert(once, non_null_s, ["k"])
    assert content(once) == content(twice)


def test_merge_actions(tables):
    t, s = tables
    counts = dict(tuple(r) for r in merge_counts(merge_upsert(t, s, ["k"], with_action=True)).collect())
    assert counts == {"update": 1, "insert": 2, "keep": 3}


def test_duplicate_source_key_fails(spark, tables):
    t, _ = tables
    s = spark.createDataFrame([(2, "B"), (2, "BB")], "k int, v string")
    merged = merge_upsert(t, s, ["k"])  # nothing runs while the plan is built
    with pytest.raises(Exception, match="several rows for key 2"):
        merged.collect()


def test_null_source_keys_are_inserted_each(spark, tables):
    t, _ = tables
    s = spark.createDataFrame([(None, "x"), (None, "x"), (2, "B")], "k int, v string")
    m = merge_upsert(t, s, ["k"], with_action=True)
    assert dict(tuple(r) for r in merge_counts(m).collect()) == {"update": 1, "insert": 2, "keep": 3}


def test_newer_target_row_stays(spark):
    t = spark.createDataFrame([(1, "new", 5), (2, "old", 1), (3, "none", None)], "k int, v string, d int")
    s = spark.createDataFrame([(1, "a", 4), (2, "b", 2), (3, "c", 1), (4, "d", 1)], "k int, v string, d int")
    got = sorted(tuple(r) for r in merge_upsert(t, s, ["k"], newer_by="d").collect())
    assert got == [(1, "new", 5), (2, "b", 2), (3, "c", 1), (4, "d", 1)]


def test_update_subset_and_insert_subset(tables):
    t, s = tables
    s2 = s.withColumn("x", F.lit(7.0))
    m = merge_upsert(t, s2.where(F.col("k").isNotNull()), ["k"], update_cols=["x"], insert_cols=["k", "v"])
    assert content(m) == sorted([(1, "a", 1.0), (2, "b", 7.0), (None, "n", 9.0), (4, "d", 4.0), (3, "C", None)],
                                key=lambda r: (r[0] is None, r))


def test_merge_into_needs_row_level_table(spark, tables):
    from snapfeed.operators.merge import merge_into_table
    t, s = tables
    t.where("k IS NOT NULL").write.mode("overwrite").saveAsTable("t_merge_plain")
    with pytest.raises(Exception) as err:
        merge_into_table(s.where("k IS NOT NULL").withColumn("x", F.lit(1.0)), "t_merge_plain", ["k"])
    assert "MERGE" in str(err.value).upper() or "SUPPORT" in str(err.value).upper()


def test_upsert_partitions_rewrites_only_touched(spark, tmp_dir):
    import os
    from snapfeed.operators.merge import merge_upsert as whole_merge
    from snapfeed.sources.tables import upsert_partitions
    root = os.path.join(tmp_dir, "staged")
    base = spark.createDataFrame([(k, f"v{k}", k % 3) for k in range(12)], "k int, v string, p int")
    upsert_partitions(spark, "t_parts", base, ["k"], "p", root)
    untouched = sorted(spark.table("t_parts").where("p = 2").inputFiles())
    src = spark.createDataFrame([(0, "new0", 0), (4, "new4", 1), (13, "ins13", 1)], "k int, v string, p int")
    touched = upsert_partitions(spark, "t_parts", src, ["k"], "p", root, validate_source=True)
    assert touched == ["0", "1"]
    assert sorted(spark.table("t_parts").where("p = 2").inputFiles()) == untouched
    want = sorted(tuple(r) for r in whole_merge(base, src, ["k"]).collect())
    assert sorted(tuple(r) for r in spark.table("t_parts").select("k", "v", "p").collect()) == want
    # a brand-new partition value is added
    upsert_partitions(spark, "t_parts", spark.createDataFrame([(15, "x", 5)], "k int, v string, p int"),
                      ["k"], "p", root)
    assert spark.table("t_parts").where("p = 5").count() == 1


def test_upsert_partitions_first_batch_empty(spark, tmp_dir):
    import os
    from snapfeed.sources.tables import upsert_partitions
    root = os.path.join(tmp_dir, "staged_empty")
    empty = spark.createDataFrame([], "k int, v string, p int")
    assert upsert_partitions(spark, "t_parts_empty", empty, ["k"], "p", root) == []
    assert spark.table("t_parts_empty").count() == 0
    upsert_partitions(spark, "t_parts_empty", spark.createDataFrame([(1, "a", 1)], "k int, v string, p int"),
                      ["k"], "p", root)
    assert [tuple(r) for r in spark.table("t_parts_empty").select("k", "v", "p").collect()] == [(1, "a", 1)]


def test_null_key_salting_in_plan(spark, tables):
    import contextlib
    import io
    t, s = tables

    def plan(df):
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain("formatted")
        return buf.getvalue()

    assert "__salt_t" in plan(merge_upsert(t, s, ["k"]))          # nullable keys: NULL rows spread
    no_salt = merge_upsert(t.where("k IS NOT NULL"), s.where("k IS NOT NULL"), ["k"], salt_null_keys=False)
    assert "__salt" not in plan(no_salt)
