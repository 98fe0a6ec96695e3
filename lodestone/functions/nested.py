"""Array, map and JSON column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def json_or_empty(s: Column, schema: str) -> Column:
    return F.from_json(F.coalesce(s, F.lit("{}")), schema)


def strict_json(s: Column, schema: str, required: list[str]) -> Column:
    """The parsed record if all required paths are present, else null: a record is taken whole or not at all."""
    parsed = F.from_json(s, schema)
    ok = parsed.isNotNull()
    for path in required:
        value = parsed
        for key in path.split("."):
            value = value[key]
        ok = ok & value.isNotNull()
    return F.when(ok, parsed)


def distinct_by(items: Column, key) -> Column:
    """First item of each key, order kept."""
    keys = F.transform(items, key)
    return F.filter(items, lambda x, i: F.array_position(keys, key(x)) == i + 1)


def first_n(items: Column, n: int) -> Column:
    return F.slice(items, 1, n)


def add_flag(flags: Column, flag: str) -> Column:
    return F.array_sort(F.array_union(F.coalesce(flags, F.array().cast("array<string>")), F.array(F.lit(flag))))


def drop_flag(flags: Column, flag: str) -> Column:
    return F.array_sort(F.array_except(F.coalesce(flags, F.array().cast("array<string>")), F.array(F.lit(flag))))


def latest_by_year(series: Column) -> Column:
    """Count of the latest year (the first listed of equal years); without years the last listed; entries without count are passed over."""
    known = F.filter(series, lambda p: p["count"].isNotNull())
    dated = F.filter(known, lambda p: p["year"].isNotNull())
    ranked = F.transform(dated, lambda p, i: F.struct(p["year"].alias("y"), (-i).alias("i"), p["count"].alias("c")))
    return F.when(F.size(dated) > 0, F.array_max(ranked)["c"]).otherwise(F.when(F.size(known) > 0, F.element_at(known, -1)["count"]))


def sparse_json(**columns: Column) -> Column:
    """JSON object without null, empty-string and empty-array members; 0 and false stay.  Strings and arrays are recognised by the caller's types."""
    return F.to_json(F.struct(*[c.alias(k) for k, c in columns.items()]))


def none_if_empty(c: Column) -> Column:
    return F.when(F.size(c) > 0, c)


def merge_key(m: Column, key: Column, value: Column) -> Column:
    """Map with one key replaced."""
    return F.map_concat(F.map_filter(m, lambda k, _: k != key), F.create_map(key, value))


def salvage_triage(s: Column) -> Column:
    """Fields of a broken or cut JSON answer; null if even the type is missing."""
    text = lambda pattern: F.nullif(F.regexp_extract(s, pattern, 1), F.lit(""))
    kind = text(r'"type"\s*:\s*"(prose|plate|blank)"')
    number = lambda name: F.coalesce(text(rf'"{name}"\s*:\s*(\d+)').try_cast("int"), F.lit(0))
    return F.when(
        kind.isNotNull(),
        F.struct(
            kind.alias("type"),
            number("n_tables").alias("n_tables"),
            number("n_images").alias("n_images"),
            text(r'"plate_kind"\s*:\s*"(map|city_view|landscape)"').alias("plate_kind"),
            F.when(s.rlike(r'"plate_title"\s*:\s*"'), F.regexp_extract(s, r'"plate_title"\s*:\s*"([^"]*)"', 1)).alias("plate_title"),
        ),
    )


def strict_schema(ddl: str) -> dict:
    """JSON schema of a DDL struct: every member required (nullable ones by type), no others allowed, to any depth."""
    from pyspark.sql import types as T

    plain = {"string": "string", "integer": "integer", "long": "integer", "double": "number", "float": "number", "boolean": "boolean"}

    def of(t: T.DataType) -> dict:
        if isinstance(t, T.StructType):
            return {"type": "object", "properties": {f.name: of(f.dataType) for f in t.fields}, "required": [f.name for f in t.fields], "additionalProperties": False}
        if isinstance(t, T.ArrayType):
            return {"type": "array", "items": of(t.elementType)}
        return {"type": [plain[t.typeName()], "null"]}

    return of(T.StructType.fromDDL(ddl))
