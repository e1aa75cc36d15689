"""Document-collection operators, set-based.

A collection is a DataFrame with a key column and one column per field (struct
columns for nested fields). A batch of per-document edits is a DataFrame too;
an optional sequence column orders several edits of one key.

Array edits are pre-aggregated per (key, value) and meet the elements of the
arrays by (key, value), so a key with a huge edit batch or array is spread over
tasks; what is finally gathered per document is what its array gets or keeps.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ARCHIVE_SUFFIX = "_archive"


def _seq_col(seq: str | None) -> Column:
    return F.col(seq) if seq else F.lit(0)


def docs_upsert(coll: DataFrame, edits: DataFrame, key: str = "key", seq: str | None = None,
                null_means_absent: bool = False) -> DataFrame:
    """Apply edits: an existing document gets the edited fields overwritten,
    a missing one is created from the edit alone (other fields NULL).

    Edit fields are the edit frame's columns other than ``key``/``seq``. With
    several edits of one key the last by ``seq`` wins, a NULL ``seq`` counting
    as before all others (partially aggregated ``max_by``); without ``seq``,
    several edits of a key fail the job, as a DataFrame has no row order.
    Edits without a key name no document and are ignored; documents without a
    key stay as they are. ``null_means_absent`` treats a NULL edit value as
    "not given".
    """
    fields = [c for c in edits.columns if c not in (key, seq)]
    unknown = [c for c in fields if c not in coll.columns]
    if unknown:
        raise KeyError(f"edit fields not in collection: {unknown}")
    order = F.struct(F.col(seq).isNotNull(), F.col(seq)) if seq else F.lit(True)
    last = (edits.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("__ek"))
            .agg(F.max_by(F.struct(*[F.col(c) for c in fields]), order).alias("__e"), F.count(F.lit(1)).alias("__n")))
    if not seq:
        last = last.where(F.when(F.col("__n") == 1, F.lit(True)).otherwise(F.raise_error(
            F.concat(F.lit("several edits without an order for document "), F.col("__ek").cast("string"))).cast("boolean")))
    with_key = coll.where(F.col(key).isNotNull()).withColumn("__c", F.lit(True))
    j = with_key.join(last, with_key[key] == last["__ek"], "full")
    types = {f.name: f.dataType for f in coll.schema.fields}
    out = []
    for name in coll.columns:
        if name == key:
            out.append(F.coalesce(F.col(key), F.col("__ek")).alias(key))
        elif name in fields:
            new = F.col(f"__e.{name}").cast(types[name])
            given = F.col("__ek").isNotNull()
            if null_means_absent:
                given = given & new.isNotNull()
            out.append(F.when(given, new).otherwise(F.col(name)).alias(name))
        else:
            out.append(F.when(F.col("__c").isNotNull(), F.col(name)).alias(name))
    edited = j.select(*out)
    return edited.unionByName(coll.where(F.col(key).isNull())) if coll.schema[key].nullable else edited


def _value_rows(edits: DataFrame, key: str, values: str, seq: str | None) -> DataFrame:
    """(key, first position, value) per distinct value of a key's edits.

    A struct ``values`` is one element (a dict added as a whole)."""
    vtype = edits.schema[values].dataType
    if isinstance(vtype, T.StructType):
        arr = F.array(F.col(values))
    elif isinstance(vtype, T.ArrayType):
        arr = F.col(values)
    else:
        raise TypeError(f"array edit values must be an array or a struct, got {vtype.simpleString()}")
    # posexplode_outer keeps an edit with an empty list as one marker row (NULL
    # position), so the key still counts as edited.
    exploded = edits.select(F.col(key).alias("__k"), _seq_col(seq).alias("__s"),
                            F.posexplode_outer(arr).alias("__p", "__v"))
    return (exploded.groupBy("__k", "__v", F.col("__p").isNull().alias("__m"))
            .agg(F.min(F.struct("__s", "__p")).alias("__first")))


def _elements(coll: DataFrame, key: str, field: str, edited: DataFrame) -> DataFrame:
    """(key, array digest, position, value): a row per element of the documents that
    are edited. The digest tells rows apart that share a key."""
    named = coll.select(F.col(key).alias("__ck"), _digest(field).alias("__h"), F.col(field).alias("__a"))
    return named.join(edited, F.col("__ck") == F.col("__k"), "left_semi").select("__ck", "__h", F.posexplode("__a").alias("__p", "__v")).distinct()


def _digest(field: str) -> Column:
    return F.sha2(F.coalesce(F.to_json(F.struct(F.col(field).alias("a"))), F.lit("")), 256)


def _with_gathered(coll: DataFrame, edited: DataFrame, lists: DataFrame, key: str, field: str, fn) -> DataFrame:
    """``coll`` with ``fn(array, gathered values)`` in the documents that are edited."""
    j = coll.withColumn("__d", _digest(field)).join(edited, F.col(key) == F.col("__k"), "left")
    j = j.join(lists, (F.col(key) == F.col("__lk")) & (F.col("__d") == F.col("__lh")), "left")
    new = F.when(F.col("__k").isNotNull(), fn(F.col(field), F.coalesce("__vals", F.array().cast(coll.schema[field].dataType)))).otherwise(F.col(field))
    return j.select(*[new.alias(c) if c == field else F.col(c) for c in coll.columns])


def _gathered(rows: DataFrame, place: list[str]) -> DataFrame:
    """Lists of ``__v`` per document in the order of ``place``."""
    entry = F.struct(*[F.col(p) for p in place], F.col("__v").alias("v"))
    lists = rows.groupBy(F.col("__ck").alias("__lk"), F.col("__h").alias("__lh")).agg(F.array_sort(F.collect_list(entry)).alias("__l"))
    return lists.select("__lk", "__lh", F.transform("__l", lambda x: x["v"]).alias("__vals"))


def array_add(coll: DataFrame, edits: DataFrame, field: str, key: str = "key",
              values: str = "values", seq: str | None = None) -> DataFrame:
    """Append each distinct edit value not already in the array (existing
    elements, duplicates included, stay as they are), in order of first
    appearance by (``seq``, position in the edit). A missing array becomes an
    array on its first edit. Edits of keys absent from the collection do
    nothing.

    Element by element: the edits' values are rows per (key, value), those that the
    document has already go by an anti join on both, and only values that come in
    are gathered."""
    each = _value_rows(edits, key, values, seq)
    edited = each.select("__k").distinct()
    have = _elements(coll, key, field, edited).select("__ck", "__h", F.col("__v").alias("__has"))
    documents = coll.select(F.col(key).alias("__ck"), _digest(field).alias("__h")).distinct()
    fresh = each.where(~F.col("__m")).join(documents, F.col("__k") == F.col("__ck")).select("__ck", "__h", "__v", "__first")
    known = [fresh[c] == have[c] for c in ("__ck", "__h")] + [F.col("__v").eqNullSafe(F.col("__has"))]
    lists = _gathered(fresh.join(have, known, "left_anti"), ["__first"])
    empty = F.array().cast(coll.schema[field].dataType)
    return _with_gathered(coll, edited, lists, key, field, lambda a, new: F.concat(F.coalesce(a, empty), new))


def array_remove(coll: DataFrame, edits: DataFrame, field: str, key: str = "key",
                 values: str = "values", seq: str | None = None) -> DataFrame:
    """Remove every occurrence of each edit value; order of the rest is kept.
    A missing array becomes an empty array when edited.

    Element by element: elements and edit values meet by (key, value), and only what
    stays is gathered, by its positions."""
    each = _value_rows(edits, key, values, seq)
    edited = each.select("__k").distinct()
    gone = each.where(~F.col("__m")).select(F.col("__k").alias("__gk"), F.col("__v").alias("__gv"))
    stay = _elements(coll, key, field, edited).join(gone, (F.col("__ck") == F.col("__gk")) & F.col("__v").eqNullSafe(F.col("__gv")), "left_anti")
    return _with_gathered(coll, edited, _gathered(stay, ["__p"]), key, field, lambda _, left: left)


def array_archive(coll: DataFrame, edits: DataFrame, field: str, **kw) -> DataFrame:
    """Add values to ``<field>_archive``."""
    return array_add(coll, edits, field + ARCHIVE_SUFFIX, **kw)


def array_unarchive(coll: DataFrame, edits: DataFrame, field: str, **kw) -> DataFrame:
    """Remove values from ``<field>_archive`` (the field itself is unchanged)."""
    return array_remove(coll, edits, field + ARCHIVE_SUFFIX, **kw)


def read_by_ids(coll: DataFrame, ids: DataFrame, key: str = "key", id_col: str = "id",
                pos_col: str = "pos") -> DataFrame:
    """Documents in request order (``pos_col`` kept for ordering); ids without
    a document are skipped. See :func:`missing_ids` for the misses."""
    j = ids.join(coll, ids[id_col] == coll[key], "inner")
    return j.select(ids[pos_col], *[coll[c] for c in coll.columns]).orderBy(pos_col)


def missing_ids(coll: DataFrame, ids: DataFrame, key: str = "key", id_col: str = "id") -> DataFrame:
    return ids.join(coll, ids[id_col] == coll[key], "left_anti")


def read_ordered(coll: DataFrame, field: str, key: str | None = "key") -> DataFrame:
    """Documents having ``field``, ascending by it, ties by document key.

    A range-partitioned sort; the key tie-break lets the range boundaries split
    a value shared by very many documents instead of giving them all to one task."""
    order = [F.col(field).asc()] + ([F.col(key).asc()] if key and key in coll.columns else [])
    return coll.where(F.col(field).isNotNull()).orderBy(*order)


_OPS = {
    "==": lambda c, v: c == F.lit(v),
    "!=": lambda c, v: c != F.lit(v),
    "<": lambda c, v: c < F.lit(v),
    "<=": lambda c, v: c <= F.lit(v),
    ">": lambda c, v: c > F.lit(v),
    ">=": lambda c, v: c >= F.lit(v),
    "in": lambda c, v: c.isin(list(v)),
    "not-in": lambda c, v: ~c.isin(list(v)),
    "array-contains": lambda c, v: F.array_contains(c, F.lit(v)),
    "array-contains-any": lambda c, v: reduce(lambda a, b: a | b, [F.array_contains(c, F.lit(x)) for x in v]),
}
# The same operators under the names that callers of document stores use too.
_OPS |= {name.replace("-", "_"): op for name, op in _OPS.items() if "-" in name}


def read_where(coll: DataFrame, field_path: str, op: str, value) -> DataFrame:
    """Documents whose field (dotted path into structs) satisfies ``op value``.

    A missing or NULL field never matches, for every operator."""
    if op not in _OPS:
        raise ValueError(f"unsupported operator {op!r}; one of {sorted(_OPS)}")
    c = F.col(field_path)
    return coll.where(F.coalesce(c.isNotNull() & _OPS[op](c, value), F.lit(False)))


def add_routing(rows: DataFrame, collection_id: str, doc_id_field: str,
                out: str = "fs_location") -> DataFrame:
    """Attach ``{collection_id, doc_id}`` naming where each row belongs."""
    return rows.withColumn(out, F.struct(F.lit(collection_id).alias("collection_id"),
                                         F.col(doc_id_field).alias("doc_id")))


def lookup_nested(messages: DataFrame, users: DataFrame, user_col: str, key: str,
                  path: str, out: str) -> DataFrame:
    """Left join each message to its user document and take a nested field
    (NULL when the user or the field is missing)."""
    u = users.select(F.col(key).alias("__uk"), F.col(path).alias(out))
    j = messages.join(u, messages[user_col] == u["__uk"], "left")
    return j.drop("__uk")
