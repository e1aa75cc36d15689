"""Documents of unknown shape against a model on Python dictionaries."""

import datetime as dt
import json
import os

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from snapfeed.operators import payloads as P

EXAMPLES = int(os.environ.get("SNAPFEED_PROPERTY_EXAMPLES", "25"))


def collection(spark, docs):
    return spark.createDataFrame([(k, None if d is None else json.dumps(d)) for k, d in docs], "key string, j string").select("key", P.to_payload("j").alias("payload"))


def edit_frame(spark, edits):
    return spark.createDataFrame([(k, json.dumps(d), s) for k, d, s in edits], "key string, j string, seq long").select("key", P.to_payload("j").alias("payload"), "seq")


def content(df):
    return {r.key: None if r.j is None else json.loads(r.j) for r in df.select("key", F.to_json("payload").alias("j")).collect()}


def model(docs, edits):
    out = {k: d for k, d in docs}
    for key, fields, _ in sorted((e for e in edits if e[0] is not None), key=lambda e: (e[2] is not None, e[2] or 0)):
        doc = json.loads(json.dumps(out.get(key))) if isinstance(out.get(key), dict) else {}
        for path in sorted(fields, key=lambda p: len(P.path_steps(p))):
            *inner, last = P.path_steps(path)
            at = doc
            for step in inner:
                if not isinstance(at.get(step), dict):
                    at[step] = {}
                at = at[step]
            at[last] = fields[path]
        out[key] = doc
    return out


DOCS = [("a", {"n": 1, "address": {"city": "x", "zip": [1, 2]}, "t": "text"}), ("b", {"n": "one"}), ("c", {}), ("d", {"address": 5}), ("e", None)]


def test_fields_differ_by_row(spark):
    edits = [("a", {"address.city": "y", "new": True}, 1), ("b", {"n": 2.5, "deep.er.still": [None]}, 1), ("c", {}, 1), ("d", {"address.city": "z"}, 1), ("e", {"x": 1}, 1),
             ("new", {"k": {"l": None}, "a.b": 1}, 1), ("empty", {}, 1)]
    assert content(P.payload_upsert(collection(spark, DOCS), edit_frame(spark, edits), seq="seq")) == model(DOCS, edits)


def test_order_of_edits(spark):
    edits = [("a", {"address": {"only": 1}}, 2), ("a", {"address.city": "lost"}, 1), ("a", {"address.kept": 3}, 3), ("a", {"n": 9}, None), ("a", {"n": 8, "`n.m`": 7}, 5)]
    got = content(P.payload_upsert(collection(spark, DOCS), edit_frame(spark, edits), seq="seq"))
    assert got["a"] == {"n": 8, "n.m": 7, "address": {"only": 1, "kept": 3}, "t": "text"} and got == model(DOCS, edits)


def test_refused_edits(spark):
    coll = collection(spark, DOCS)
    twice = edit_frame(spark, [("a", {"n": 1}, 1), ("a", {"n": 2}, 2)]).drop("seq")
    for bad, args in ((twice, {}), (edit_frame(spark, [("a", [1], 1)]), {"seq": "seq"}), (edit_frame(spark, [("a", {"x.y.z": 1}, 1)]), {"seq": "seq", "depth": 2})):
        with pytest.raises(Exception, match="several edits|not an object|more than 2 steps"):
            P.payload_upsert(coll, bad, **args).collect()
    with pytest.raises(ValueError):
        P.path_steps("a..b")
    assert P.path_steps("a.`b.c`.d") == ["a", "b.c", "d"]


def test_null_and_missing_keys(spark):
    coll = collection(spark, [*DOCS, (None, {"own": 1})])
    got = content(P.payload_upsert(coll, edit_frame(spark, [(None, {"n": 3}, 1), ("b", {"n": 3}, 1)]), seq="seq"))
    assert got[None] == {"own": 1} and got["b"] == {"n": 3} and len(got) == 6
    assert content(P.payload_upsert(coll.where("false"), edit_frame(spark, [("z", {"n": 3}, 1)]), seq="seq")) == {"z": {"n": 3}}


names = st.sampled_from(["a", "b", "c.d", "c.e", "c", "c.d.f"])
values = st.sampled_from([None, 1, 2.5, "t", [1], {"d": 1}, {"e": {"f": 2}}])
doc = st.dictionaries(st.sampled_from(["a", "b", "c"]), values, max_size=3)
# Within one edit no path lies below another (that has no order).
fields = st.dictionaries(names, values, max_size=3).filter(lambda f: not any(p != q and q.startswith(p + ".") for p in f for q in f))


@settings(max_examples=EXAMPLES, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("xyz"), doc), max_size=3, unique_by=lambda d: d[0]),
       st.lists(st.tuples(st.sampled_from("xyzw"), fields, st.integers(0, 50)), max_size=6, unique_by=lambda e: e[2]))
def test_upsert_matches_model(spark, docs, edits):
    assert content(P.payload_upsert(collection(spark, docs), edit_frame(spark, edits), seq="seq")) == model(docs, edits)


MIXED = [("01", {"f": None}), ("02", {"f": False}), ("03", {"f": True}), ("04", {"f": -5}), ("05", {"f": 2.5}), ("06", {"f": 3}), ("07", {"f": 2**53 + 1}), ("08", {"f": 2**53 + 2}),
         ("09", {"f": "3"}), ("10", {"f": "a"}), ("11", {"f": [1, "x"]}), ("12", {"f": {"g": 3}}), ("13", {}), ("14", None)]


def test_ordering_goes_across_types(spark):
    got = [r.key for r in P.payload_ordered(collection(spark, MIXED[::-1]), "f").collect()]
    assert got == [k for k, d in MIXED if d and "f" in d]


@pytest.mark.parametrize("path, op, value, keys", [
    ("f", "==", 3, ["06"]), ("f", "==", "3", ["09"]), ("f", "==", None, ["01"]), ("f", ">", 2, ["05", "06", "07", "08"]), ("f", "<=", 2.5, ["04", "05"]), ("f", ">", 2**53 + 1, ["08"]),
    ("f", "<", "a", ["09"]), ("f", "==", True, ["03"]), ("f", "!=", 3, ["02", "03", "04", "05", "07", "08", "09", "10", "11", "12"]), ("f", "in", [3, "a", None], ["01", "06", "10"]),
    ("f", "not-in", [3, "a"], ["02", "03", "04", "05", "07", "08", "09", "11", "12"]), ("f", "array_contains", "x", ["11"]), ("f", "array-contains", 3, []),
    ("f", "array-contains-any", [7, 1], ["11"]), ("f.g", "==", 3, ["12"]), ("f.g", ">=", 4, []), ("nothing", "!=", 1, []), ("f", "<", None, [])])
def test_filters_meet_only_their_own_kind(spark, path, op, value, keys):
    assert sorted(r.key for r in P.payload_where(collection(spark, MIXED), path, op, value).collect()) == keys


def test_times_and_unknown_operators(spark):
    day = dt.date(2024, 5, 1)
    coll = spark.createDataFrame([("a", day)], "key string, d date").select("key", F.to_variant_object(F.struct("d")).alias("payload"))
    assert [r.key for r in P.payload_where(coll, "d", "<", dt.datetime(2024, 5, 2)).collect()] == ["a"]
    with pytest.raises(ValueError):
        P.payload_where(coll, "d", "like", "x")
    with pytest.raises(TypeError):
        P.payload_where(coll, "d", "==", object())
