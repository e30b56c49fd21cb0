"""Nested documents against a schema that is itself a document (V1).

A schema is compiled to one Column over a VARIANT: a list of what breaks it,
each with the path of the part that does.  Types, enum, const, pattern, bounds,
required, dependentRequired, properties, additionalProperties, items, anyOf and
if/then/else are read; what a schema does not name is free.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BREACH = "array<struct<path:string,rule:string>>"
KINDS = {"object": "OBJECT", "array": "ARRAY", "string": "STRING", "boolean": "BOOLEAN", "null": "VOID", "integer": "BIGINT", "number": "BIGINT|DECIMAL|DOUBLE|FLOAT"}


def _kind(v: Column) -> Column:
    return F.regexp_extract(F.schema_of_variant(v), "^[A-Z]+", 0)


def _field(v: Column, name: str) -> Column:
    """A field of an object; null where it has none."""
    return F.when(_kind(v) == "OBJECT", F.try_variant_get(v, f"$['{name}']", "variant"))


def _one(bad: Column, path: Column, rule: str) -> Column:
    none = F.expr(f"cast(array() as {BREACH})")
    return F.when(F.coalesce(bad, F.lit(False)), F.array(F.struct(path.alias("path"), F.lit(rule).alias("rule"))).cast(BREACH)).otherwise(none)


def breaches(schema: dict, v: Column, path: Column) -> Column:
    """The list of (path, rule) that the variant breaks; a value of the wrong type breaks nothing else."""
    found, kind = [], _kind(v)
    text, number = F.when(kind == "STRING", F.try_variant_get(v, "$", "string")), F.when(kind.rlike(f"^({KINDS['number']})$"), F.try_variant_get(v, "$", "double"))
    items = F.when(kind == "ARRAY", F.try_variant_get(v, "$", "array<variant>"))
    below = lambda name: F.concat(path, F.lit(f".{name}"))
    same = lambda x: F.to_json(v) == F.to_json(F.parse_json(F.lit(json.dumps(x))))
    if "enum" in schema or "const" in schema:
        found.append(_one(~reduce(Column.__or__, map(same, schema.get("enum", [schema.get("const")]))), path, "is not listed"))
    if "pattern" in schema:
        found.append(_one(~text.rlike(schema["pattern"]), path, "has another form"))
    for key, bad in (("minLength", lambda n: F.length(text) < n), ("maxLength", lambda n: F.length(text) > n), ("minimum", lambda n: number < n), ("maximum", lambda n: number > n), ("minItems", lambda n: F.size(items) < n), ("maxItems", lambda n: F.size(items) > n)):
        if key in schema:
            found.append(_one(bad(schema[key]), path, f"breaks {key}"))
    if schema.get("uniqueItems"):
        texts = F.transform(items, lambda x: F.to_json(x))
        found.append(_one(F.size(F.array_distinct(texts)) < F.size(texts), path, "repeats an item"))
    for name in schema.get("required", []):
        found.append(_one((kind == "OBJECT") & _field(v, name).isNull(), below(name), "is missing"))
    for name, others in schema.get("dependentRequired", {}).items():
        found += [_one(_field(v, name).isNotNull() & _field(v, o).isNull(), below(o), f"is missing beside {name}") for o in others]
    for name, inner in schema.get("properties", {}).items():
        own = _field(v, name)
        found.append(F.when(own.isNotNull(), breaches(inner, own, below(name))).otherwise(F.expr(f"cast(array() as {BREACH})")))
    if schema.get("additionalProperties") is False:
        more = F.array_except(F.json_object_keys(F.to_json(v)), F.array(*map(F.lit, schema.get("properties", {}))).cast("array<string>"))
        each = F.transform(more, lambda k: F.struct(F.concat(path, F.lit("."), k).alias("path"), F.lit("is not allowed").alias("rule"))).cast(BREACH)
        found.append(F.when(kind == "OBJECT", each).otherwise(F.expr(f"cast(array() as {BREACH})")))
    if "items" in schema:
        inner = F.flatten(F.transform(items, lambda x, k: breaches(schema["items"], x, F.concat(path, F.lit("["), k.cast("string"), F.lit("]")))))
        found.append(F.coalesce(inner, F.expr(f"cast(array() as {BREACH})")))
    if "anyOf" in schema:
        found.append(_one(~reduce(Column.__or__, [F.size(breaches(s, v, path)) == 0 for s in schema["anyOf"]]), path, "fits no alternative"))
    if "if" in schema:
        then, other = (breaches(schema.get(k, {}), v, path) for k in ("then", "else"))
        found.append(F.when(F.size(breaches(schema["if"], v, path)) == 0, then).otherwise(other))
    all_of = F.concat(*found) if found else F.expr(f"cast(array() as {BREACH})")
    if "type" not in schema:
        return all_of
    kinds = schema["type"] if isinstance(schema["type"], list) else [schema["type"]]
    return F.when(kind.rlike(f"^({'|'.join(KINDS[k] for k in kinds)})$"), all_of).otherwise(_one(F.lit(True), path, f"is no {' or '.join(kinds)}"))


def nested_breaches(rows: DataFrame, key: str, text: str, schema: dict) -> DataFrame:
    """key, path, rule: a row for everything in a JSON document that breaks the schema; what is no JSON (or null) breaks it as a whole."""
    v = F.try_parse_json(text)
    unread = _one(F.lit(True), F.lit("$"), "is no document")
    found = rows.select(F.col(key), F.explode(F.when(v.isNull(), unread).otherwise(breaches(schema, v, F.lit("$")))).alias("b"))
    return found.select(key, "b.path", "b.rule")
