"""Collections of documents of mixed shape in one VARIANT column: filters and updates by path, kinds per path, revisions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NUMBERS = ("BIGINT", "DOUBLE", "FLOAT", "DECIMAL")
#: Levels of nesting that ``path_kinds`` lists.
LEVELS = 6


def collection(df: DataFrame, json: str, id_col: str, doc: str = "doc") -> tuple[DataFrame, DataFrame]:
    """Documents (id, VARIANT) of a column of JSON texts, and the rows whose text is no JSON."""
    parsed = df.select(id_col, F.col(json).alias("__text"), F.try_parse_json(json).alias(doc))
    return parsed.filter(F.col(doc).isNotNull()).select(id_col, doc), parsed.filter(F.col(doc).isNull()).select(
        id_col, F.col("__text").alias(json))


def _steps(path: str) -> list[str]:
    return path.split(".")


def _segment(name: str) -> str:
    """One step of a path; a name may hold quotes of one kind."""
    if "'" in name and '"' in name:
        raise ValueError(f"a field name with both kinds of quotes: {name}")
    return f'["{name}"]' if "'" in name else f"['{name}']"


def at(doc: Column | str, path: str) -> Column:
    """The value at a dotted path of field names, as VARIANT; null where there is none."""
    return F.try_variant_get(F.col(doc) if isinstance(doc, str) else doc, "$" + "".join(map(_segment, _steps(path))), "variant")


def kind(value: Column) -> Column:
    """number, string, boolean, null, object, array or the engine's own name of another kind; null for a missing value."""
    name = F.regexp_extract(F.schema_of_variant(value), r"^(\w+)", 1)
    return (
        F.when(name.isin(*NUMBERS), "number").when(name == "VOID", "null")
        .otherwise(F.lower(name))
    )


_COMPARE = {
    "$eq": lambda x, y: x == y, "$gt": lambda x, y: x > y, "$gte": lambda x, y: x >= y, "$lt": lambda x, y: x < y, "$lte": lambda x, y: x <= y,
}


def _test(value: Column, op: str, bound) -> Column:
    """Comparison within the bound's kind; whole numbers are compared as such."""
    as_ = lambda t: F.try_variant_get(value, "$", t)
    if isinstance(bound, bool):
        held = (kind(value) == "boolean") & _COMPARE[op](as_("boolean"), F.lit(bound))
    elif isinstance(bound, int):
        whole = F.startswith(F.schema_of_variant(value), F.lit("BIGINT"))
        held = (kind(value) == "number") & F.when(whole, _COMPARE[op](as_("bigint"), F.lit(bound).cast("bigint"))).otherwise(
            _COMPARE[op](as_("double"), F.lit(float(bound))))
    elif isinstance(bound, float):
        held = (kind(value) == "number") & _COMPARE[op](as_("double"), F.lit(bound))
    elif isinstance(bound, str):
        held = (kind(value) == "string") & _COMPARE[op](as_("string"), F.lit(bound))
    else:
        raise TypeError(f"no comparison with {bound!r}")
    return F.coalesce(held, F.lit(False))


def _holds(value: Column, op: str, bound) -> Column:
    """The test of one operator on a value, or on any element if the value is an array."""
    if op == "$exists":
        return value.isNotNull() if bound else value.isNull()
    if op == "$ne":
        return ~_holds(value, "$eq", bound)
    if op == "$in":
        return reduce(lambda a, b: a | b, [_holds(value, "$eq", b) for b in bound], F.lit(False))
    if op == "$eq" and bound is None:
        return value.isNull() | F.is_variant_null(value)
    elements = F.try_variant_get(value, "$", "array<variant>")
    return _test(value, op, bound) | F.coalesce(F.exists(elements, lambda x: _test(x, op, bound)), F.lit(False))


def matches(query: Mapping[str, object], doc: Column | str = "doc") -> Column:
    """Condition of a query ``{path: value}`` or ``{path: {"$gt": bound, ...}}``, with ``$and`` and ``$or`` over lists of queries.

    Values are compared within their kind only: a number never matches a text that looks like it, an absent path matches nothing
    but ``None``, ``$ne`` and ``{"$exists": False}``. A value that is an array matches by itself or by any element. Fields of
    fixed paths are read from the files without the rest of the document.
    """
    conds = []
    for path, want in query.items():
        if path in ("$or", "$and"):
            parts = [matches(q, doc) for q in want]
            conds.append(reduce((lambda a, b: a | b) if path == "$or" else (lambda a, b: a & b), parts))
        elif isinstance(want, Mapping):
            conds += [_holds(at(doc, path), op, bound) for op, bound in want.items()]
        else:
            conds.append(_holds(at(doc, path), "$eq", want))
    return reduce(lambda a, b: a & b, conds, F.lit(True))


def find(df: DataFrame, query: Mapping[str, object], doc: str = "doc", order: Sequence[str] = (), limit: int | None = None) -> DataFrame:
    out = df.filter(matches(query, doc))
    out = out.orderBy(*order) if order else out
    return out if limit is None else out.limit(limit)


def _fields(doc: Column) -> Column:
    """The fields of an object; anything else has none."""
    none = F.try_variant_get(F.parse_json(F.lit("{}")), "$", "map<string,variant>")
    return F.coalesce(F.try_variant_get(doc, "$", "map<string,variant>"), none)


def with_path(doc: Column, path: str, value: Column) -> Column:
    """The document with a value set at a path; objects on the way are made, and what is in the way and no object is replaced."""
    step, *rest = _steps(path)
    inner = value.cast("variant") if not rest else with_path(at(doc, step),
                                                            ".".join(rest), value)
    others = F.map_filter(_fields(doc), lambda k, _: k != F.lit(step))
    return F.to_variant_object(F.map_concat(others, F.create_map(F.lit(step), inner)))


def without_path(doc: Column, path: str) -> Column:
    """The document without the value at a path; a path that is not there changes nothing."""
    step, *rest = _steps(path)
    others = F.map_filter(_fields(doc), lambda k, _: k != F.lit(step))
    if not rest:
        cut = F.to_variant_object(others)
    else:
        inner = at(doc, step)
        cut = F.to_variant_object(F.map_concat(others, F.create_map(F.lit(step), without_path(inner, ".".join(rest)))))
    return F.when(at(doc, path).isNotNull(), cut).otherwise(doc)


def _assigned(doc: Column, assignments: Mapping[str, object]) -> Column:
    for path, value in assignments.items():
        doc = with_path(doc, path, value if isinstance(value, Column) else F.lit(value))
    return doc


def update(df: DataFrame, query: Mapping[str, object], assignments: Mapping[str, object], doc: str = "doc") -> DataFrame:
    """Set paths in every matching document."""
    hit = matches(query, doc)
    return df.withColumn(doc, F.when(hit, _assigned(F.col(doc), assignments)).otherwise(F.col(doc)))


def update_one(df: DataFrame, query: Mapping[str, object], assignments: Mapping[str, object], id_col: str, doc: str = "doc") -> DataFrame:
    """Set paths in the matching document with the smallest id only."""
    first = df.filter(matches(query, doc)).agg(F.min(id_col)).scalar()
    return df.withColumn(doc, F.when(F.col(id_col) == first, _assigned(F.col(doc), assignments)).otherwise(F.col(doc)))


def path_kinds(df: DataFrame, doc: str = "doc", levels: int = LEVELS) -> DataFrame:
    """path, kind, n: how many documents' values of each kind stand at each path, as an aggregate.

    Elements of an array stand at ``path[]``. What is nested deeper than ``levels`` is not listed.
    """
    level = df.select(F.lit("").alias("path"), F.col(doc).alias("v")).filter(F.col("v").isNotNull())
    parts = []
    for _ in range(levels):
        fields = level.select("path", F.explode(_fields(F.col("v"))).alias("name", "v")).select(
            F.when(F.col("path") == "", F.col("name")).otherwise(F.concat("path", F.lit("."), "name")).alias("path"), "v")
        elements = level.select(F.concat("path", F.lit("[]")).alias("path"), F.explode(F.try_variant_get("v", "$", "array<variant>")).alias("v"))
        level = fields.unionByName(elements)
        parts.append(level.select("path", kind(F.col("v")).alias("kind")))
    return reduce(DataFrame.unionByName, parts).groupBy("path", "kind").agg(F.count(F.lit(1)).alias("n"))


def merged_type(df: DataFrame, doc: str = "doc") -> DataFrame:
    """The one type that all documents fit, as text (``VARIANT`` where kinds differ)."""
    return df.agg(F.schema_of_variant_agg(doc).alias("merged_type"))


def revisions(df: DataFrame, query: Mapping[str, object], assignments: Mapping[str, object], id_col: str, ref_col: str, doc: str = "doc") -> DataFrame:
    """Changed copies of the matching documents, with an id of their own (a digest of original and content) and the original's."""
    changed = find(df, query, doc).select(F.col(id_col).alias(ref_col), _assigned(F.col(doc), assignments).alias(doc))
    own = F.sha2(F.concat_ws(":", F.col(ref_col).cast("string"), F.to_json(doc)), 256)
    return changed.select(own.alias(id_col), ref_col, doc)


def compare(originals: DataFrame, revised: DataFrame, id_col: str, ref_col: str, paths: Sequence[str], doc: str = "doc") -> DataFrame:
    """Original and revision ids with one flag per path (dots as underscores) that says whether the value there differs."""
    old = originals.select(F.col(id_col).alias("original_id"), F.col(doc).alias("__old"))
    new = revised.select(F.col(id_col).alias("revision_id"), F.col(ref_col).alias("__ref"), F.col(doc).alias("__new"))
    pairs = old.join(new, F.col("original_id") == F.col("__ref"))
    text = lambda side, path: F.to_json(at(side, path))
    return pairs.select("original_id", "revision_id", *[
        (~text("__old", p).eqNullSafe(text("__new", p))).alias(p.replace(".", "_") + "_changed") for p in paths])
