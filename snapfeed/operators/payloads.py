"""Document collections of unknown shape: a key column and a VARIANT payload, whose
fields may differ from document to document in name, nesting and type.

Fields are named by dotted paths (``address.city``); a name with dots or other marks
is one path step when quoted in backticks (`` `a.b` ``). Values of different types
never compare: a filter only meets values of its own type, and an ordering goes by
type first (null, boolean, number, time, text, binary, array, object), as document
stores do.
"""

from __future__ import annotations

import datetime as _dt
import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAP = "map<string,variant>"
_STEP = re.compile(r"`((?:[^`]|``)+)`|([^.`]+)")
TYPE_ORDER = ["null", "boolean", "number", "time", "text", "binary", "array", "object"]


def to_payload(json_text: Column | str, strict: bool = True) -> Column:
    """JSON text as a VARIANT; text that isn't JSON fails the job, or is NULL when
    not ``strict``."""
    return F.parse_json(json_text) if strict else F.try_parse_json(json_text)


def path_steps(path: str) -> list[str]:
    """``a.`b.c`.d`` -> ['a', 'b.c', 'd']."""
    steps, at = [], 0
    while at <= len(path):
        m = _STEP.match(path, at)
        if not m or (m.end() < len(path) and path[m.end()] != "."):
            raise ValueError(f"not a field path: {path!r}")
        steps.append(m[1].replace("``", "`") if m[1] else m[2])
        at = m.end() + 1
    return steps


def field(payload: Column | str, path: str) -> Column:
    """The VARIANT at a path; NULL where a step is missing or not an object."""
    value = F.col(payload) if isinstance(payload, str) else payload
    for step in path_steps(path):
        value = F.try_variant_get(value, "$", MAP)[step]
    return value


def value_kind(value: Column) -> Column:
    """One of ``TYPE_ORDER``; NULL for a missing value."""
    t = F.schema_of_variant(value)
    return (F.when(t == "VOID", "null").when(t == "BOOLEAN", "boolean").when(t == "STRING", "text").when(t == "BINARY", "binary")
            .when(t.startswith("OBJECT"), "object").when(t.startswith("ARRAY"), "array")
            .when(t.startswith("TIMESTAMP") | (t == "DATE"), "time").when(t.isNotNull(), "number"))


def _number(value: Column) -> Column:
    """A number as DECIMAL where it fits exactly, for exact comparison of long integers."""
    return F.try_variant_get(value, "$", "decimal(38,9)")


def _plain(value) -> tuple[str, Column]:
    """Kind and column of a Python literal."""
    if value is None:
        return "null", F.lit(None)
    if isinstance(value, bool):
        return "boolean", F.lit(value)
    if isinstance(value, (int, float)):
        return "number", F.lit(value)
    if isinstance(value, (_dt.date, _dt.datetime)):
        return "time", F.lit(value).cast("timestamp")
    if isinstance(value, (bytes, bytearray)):
        return "binary", F.lit(bytes(value))
    if isinstance(value, str):
        return "text", F.lit(value)
    raise TypeError(f"cannot compare a field with {type(value).__name__}")


_GETTERS = {"boolean": "boolean", "time": "timestamp", "text": "string", "binary": "binary"}


def _as(value: Column, kind: str, other) -> Column:
    if kind == "number":
        return F.try_variant_get(value, "$", "double") if isinstance(other, float) else _number(value)
    return F.try_variant_get(value, "$", _GETTERS[kind])


def _same(value: Column, other) -> Column:
    """Whether a value equals a literal of its own kind (false for a missing one)."""
    kind, lit = _plain(other)
    if kind == "null":
        return F.coalesce(F.is_variant_null(value), F.lit(False))
    equal = _as(value, kind, other) == lit
    if kind == "number" and not isinstance(other, float):
        equal = F.coalesce(equal, F.try_variant_get(value, "$", "double") == lit.cast("double"))
    return F.coalesce((value_kind(value) == kind) & equal, F.lit(False))


def _compared(value: Column, other, test) -> Column:
    kind, lit = _plain(other)
    if kind == "null":
        return F.lit(False)
    result = test(_as(value, kind, other), lit)
    if kind == "number" and not isinstance(other, float):  # beyond the decimal's range
        result = F.coalesce(result, test(F.try_variant_get(value, "$", "double"), lit.cast("double")))
    return F.coalesce((value_kind(value) == kind) & result, F.lit(False))


def _there(value: Column) -> Column:
    """Present and not null: what the negated filters ask for."""
    return value.isNotNull() & ~F.coalesce(F.is_variant_null(value), F.lit(True))


def _any(tests: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def _elements(value: Column) -> Column:
    return F.coalesce(F.try_variant_get(value, "$", "array<variant>"), F.array().cast("array<variant>"))


_FILTERS = {
    "==": lambda v, x: _same(v, x),
    "!=": lambda v, x: _there(v) & ~_same(v, x),
    "<": lambda v, x: _compared(v, x, lambda a, b: a < b),
    "<=": lambda v, x: _compared(v, x, lambda a, b: a <= b),
    ">": lambda v, x: _compared(v, x, lambda a, b: a > b),
    ">=": lambda v, x: _compared(v, x, lambda a, b: a >= b),
    "in": lambda v, x: _any([_same(v, y) for y in x]),
    "not-in": lambda v, x: _there(v) & ~_any([_same(v, y) for y in x]),
    "array-contains": lambda v, x: F.exists(_elements(v), lambda e: _same(e, x)),
    "array-contains-any": lambda v, x: F.exists(_elements(v), lambda e: _any([_same(e, y) for y in x])),
}
_FILTERS |= {name.replace("-", "_"): op for name, op in _FILTERS.items() if "-" in name}


def payload_where(coll: DataFrame, path: str, op: str, value, payload: str = "payload") -> DataFrame:
    """Documents whose field at ``path`` satisfies ``op value``; a missing field never
    matches, and a value of another kind matches only ``!=`` and ``not-in``."""
    if op not in _FILTERS:
        raise ValueError(f"unsupported operator {op!r}; one of {sorted(_FILTERS)}")
    return coll.where(_FILTERS[op](field(payload, path), value))


def order_key(value: Column) -> Column:
    """A struct that orders values of all kinds: by kind, then within it. Arrays and
    objects go by their JSON text."""
    kind = value_kind(value)
    rank = F.array_position(F.array(*map(F.lit, TYPE_ORDER)), kind)
    return F.struct(
        rank.alias("kind"), F.when(kind == "boolean", F.try_variant_get(value, "$", "boolean")).alias("flag"),
        F.when(kind == "number", F.try_variant_get(value, "$", "double")).alias("near"), F.when(kind == "number", _number(value)).alias("exact"),
        F.when(kind == "time", F.try_variant_get(value, "$", "timestamp")).alias("time"),
        F.when(kind.isin("text"), F.try_variant_get(value, "$", "string")).when(kind.isin("array", "object"), F.to_json(value)).alias("text"),
        F.when(kind == "binary", F.try_variant_get(value, "$", "binary")).alias("bytes"))


def payload_ordered(coll: DataFrame, path: str, key: str = "key", payload: str = "payload") -> DataFrame:
    """Documents having the field, ascending by it across types, ties by key (a
    range-partitioned sort; the key splits a value that very many documents share)."""
    value = field(payload, path)
    return coll.where(value.isNotNull()).orderBy(order_key(value).asc(), F.col(key).asc())


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _assigned(base: Column, entries: Column, depth: int) -> Column:
    """``base`` with the entries (path, value) set; a step into a value that isn't an
    object replaces it by one. Every level names its values once, so the expression
    grows with the depth and no faster."""
    whole = F.filter(entries, lambda e: F.size(e["path"]) == 0)
    base = F.when(F.size(whole) > 0, F.element_at(F.transform(whole, lambda e: e["value"]), 1)).otherwise(base)
    if depth == 0:
        return base
    inner = F.filter(entries, lambda e: F.size(e["path"]) > 0)
    names = F.array_distinct(F.transform(inner, lambda e: e["path"][0]))
    empty = F.map_from_entries(F.array().cast("array<struct<key:string,value:variant>>"))

    def below(x: Column) -> Column:
        def under(name: Column) -> Column:
            mine = F.transform(F.filter(x["inner"], lambda e: e["path"][0] == name), lambda e: F.struct(
                F.slice(e["path"], 2, F.greatest(F.size(e["path"]), F.lit(1))).alias("path"), e["value"].alias("value")))
            return F.struct(name.alias("key"), _let(F.struct(x["old"][name].alias("old"), mine.alias("mine")), lambda y: _assigned(y["old"], y["mine"], depth - 1)).alias("value"))

        kept = F.map_filter(x["old"], lambda k, _: ~F.array_contains(x["names"], k))
        return F.to_variant_object(F.map_concat(kept, F.map_from_entries(F.transform(x["names"], under))))

    def level(x: Column) -> Column:
        whole_map = F.coalesce(F.try_variant_get(x["base"], "$", MAP), empty)
        return F.when(F.size(x["inner"]) == 0, x["base"]).otherwise(
            _let(F.struct(x["inner"].alias("inner"), x["names"].alias("names"), whole_map.alias("old")), below))

    return _let(F.struct(base.alias("base"), inner.alias("inner"), names.alias("names")), level)


def payload_upsert(coll: DataFrame, edits: DataFrame, key: str = "key", payload: str = "payload", seq: str | None = None, depth: int = 5) -> DataFrame:
    """Apply edits (key, payload of the given fields): a document that exists gets
    those fields set, a missing one is created from them.

    A field name of an edit is a path: ``address.city`` sets that field and leaves its
    siblings, ``address`` replaces the whole field. A null value sets null. Several
    edits of one key apply in the order of ``seq`` (a NULL ``seq`` first): of equal
    paths the last wins, and an edit of a whole field overrides earlier edits below
    it. Without ``seq``, several edits of a key fail the job. Edits without a key, and
    documents without one, are as in ``docs_upsert``. A payload that is not an
    object, and a path of more than ``depth`` steps, fail the job.

    Fields are reduced per (key, path) before anything is gathered per key; what is
    gathered is the document's own set of edited paths."""
    order = F.struct(F.col(seq).isNotNull(), F.col(seq)) if seq else F.struct(F.lit(True), F.lit(0))
    given = F.try_variant_get(payload, "$", MAP)
    fails = lambda text: F.raise_error(F.concat(F.lit(text), F.coalesce(F.col(key).cast("string"), F.lit("NULL")))).cast("boolean")
    named = edits.where(F.col(key).isNotNull()).withColumn("__m", given)
    named = named.where(F.when(F.col("__m").isNotNull(), F.lit(True)).otherwise(fails("edit payload is not an object: ")))
    if not seq:  # the check keeps the edits' rows; it is a grouping by key of its own
        counted = named.groupBy(F.col(key).alias("__ck")).agg(F.count(F.lit(1)).alias("__n"))
        counted = counted.where(F.when(F.col("__n") == 1, F.lit(True)).otherwise(
            F.raise_error(F.concat(F.lit("several edits without an order for document "), F.col("__ck").cast("string"))).cast("boolean")))
        named = named.join(counted, F.col(key) == F.col("__ck")).drop("__ck", "__n")
    # An edit without fields still creates its document: one row with no path.
    each = named.select(F.col(key).alias("__ek"), order.alias("__s"), F.explode_outer(F.map_entries("__m")).alias("__f"))
    steps = F.transform(F.regexp_extract_all(F.col("__f.key"), F.lit(r"(`(?:[^`]|``)+`|[^.`]+)"), 1),
                        lambda s: F.when(s.startswith("`"), F.replace(F.substring(s, F.lit(2), F.length(s) - 2), F.lit("``"), F.lit("`"))).otherwise(s))
    each = each.select("__ek", "__s", F.when(F.col("__f").isNotNull(), steps).alias("__path"), F.col("__f.value").alias("__v"))
    each = each.where(F.when(F.coalesce(F.size("__path"), F.lit(0)) <= depth, F.lit(True)).otherwise(F.raise_error(F.lit(f"an edit's path has more than {depth} steps")).cast("boolean")))
    last = each.groupBy("__ek", "__path").agg(F.max_by(F.struct("__v"), "__s").alias("__v"), F.max("__s").alias("__s"))
    entry = F.when(F.col("__path").isNotNull(), F.struct(F.col("__path").alias("path"), F.col("__s").alias("seq"), F.col("__v.__v").alias("value")))
    listed = last.groupBy("__ek").agg(F.collect_list(entry).alias("__l"))
    above = lambda a, b: (F.size(a["path"]) < F.size(b["path"])) & (F.slice(b["path"], 1, F.greatest(F.size(a["path"]), F.lit(1))) == a["path"]) & (a["seq"] > b["seq"])
    valid = F.filter("__l", lambda b: ~F.exists("__l", lambda a: above(a, b)))
    listed = listed.select("__ek", F.transform(valid, lambda e: F.struct(e["path"].alias("path"), e["value"].alias("value"))).alias("__l"))

    with_key = coll.where(F.col(key).isNotNull())
    j = with_key.join(listed, with_key[key] == listed["__ek"], "full")
    start = F.coalesce(F.col(payload), F.to_variant_object(F.map_from_entries(F.array().cast("array<struct<key:string,value:variant>>"))))
    new = F.when(F.col("__ek").isNull(), F.col(payload)).otherwise(_assigned(start, F.col("__l"), depth))
    out = {key: F.coalesce(F.col(key), F.col("__ek")).alias(key), payload: new.alias(payload)}
    done = j.select(*(out.get(c, F.col(c)) for c in coll.columns))
    return done.unionByName(coll.where(F.col(key).isNull())) if coll.schema[key].nullable else done
