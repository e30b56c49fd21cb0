"""Nested documents against a plain reading of the same schema."""

import json
import random
import re

from loomwork.operators import documents

SCHEMA = {
    "type": "object", "required": ["id", "steps"], "additionalProperties": False, "dependentRequired": {"from": ["to"]},
    "properties": {
        "id": {"type": "string", "pattern": "^[a-z]+$", "minLength": 2, "maxLength": 4}, "kind": {"enum": ["a", 1, None, True]}, "from": {"type": ["integer", "null"], "minimum": 0, "maximum": 5}, "to": {},
        "steps": {"type": "array", "minItems": 1, "maxItems": 3, "uniqueItems": True, "items": {"type": "object", "properties": {"n": {"type": "number"}, "at": {"type": "array", "items": {"type": "array", "items": {"type": "integer"}, "minItems": 2}}},
                  "anyOf": [{"required": ["n"]}, {"required": ["at"]}], "if": {"properties": {"n": {"const": 0}}, "required": ["n"]}, "then": {"required": ["zero"]}, "else": {"properties": {"zero": {"type": "null"}}}}},
    },
}
IS = {"object": dict, "array": list, "string": str, "boolean": bool, "null": type(None)}


def fits(kind, x):
    if kind in ("integer", "number"):
        return isinstance(x, int) and not isinstance(x, bool) or kind == "number" and isinstance(x, float)
    return isinstance(x, IS[kind])


def plain(s, x, path="$"):
    if "type" in s:
        kinds = s["type"] if isinstance(s["type"], list) else [s["type"]]
        if not any(fits(k, x) for k in kinds):
            return [(path, f"is no {' or '.join(kinds)}")]
    out, same = [], lambda a, b: json.dumps(a) == json.dumps(b)
    if "enum" in s and not any(same(x, e) for e in s["enum"]) or "const" in s and not same(x, s["const"]):
        out.append((path, "is not listed"))
    if isinstance(x, str):
        out += [(path, "has another form")] * ("pattern" in s and not re.search(s["pattern"], x))
        out += [(path, f"breaks {k}") for k, bad in (("minLength", lambda n: len(x) < n), ("maxLength", lambda n: len(x) > n)) if k in s and bad(s[k])]
    if fits("number", x):
        out += [(path, f"breaks {k}") for k, bad in (("minimum", lambda n: x < n), ("maximum", lambda n: x > n)) if k in s and bad(s[k])]
    if isinstance(x, list):
        out += [(path, f"breaks {k}") for k, bad in (("minItems", lambda n: len(x) < n), ("maxItems", lambda n: len(x) > n)) if k in s and bad(s[k])]
        out += [(path, "repeats an item")] * bool(s.get("uniqueItems") and len({json.dumps(i, sort_keys=True) for i in x}) < len(x))
        out += [b for k, i in enumerate(x) for b in plain(s.get("items", {}), i, f"{path}[{k}]")]
    if isinstance(x, dict):
        out += [(f"{path}.{k}", "is missing") for k in s.get("required", []) if k not in x]
        out += [(f"{path}.{o}", f"is missing beside {k}") for k, os in s.get("dependentRequired", {}).items() if k in x for o in os if o not in x]
        out += [b for k, inner in s.get("properties", {}).items() if k in x for b in plain(inner, x[k], f"{path}.{k}")]
        out += [(f"{path}.{k}", "is not allowed") for k in x if s.get("additionalProperties") is False and k not in s["properties"]]
    if "anyOf" in s and all(plain(a, x, path) for a in s["anyOf"]):
        out.append((path, "fits no alternative"))
    if "if" in s:
        out += plain(s.get("else" if plain(s["if"], x, path) else "then", {}), x, path)
    return out


def document(rng):
    pick = rng.choice
    value = lambda: pick([None, True, 0, 1, 3, 7, -1, 1.5, "", "ab", "abcde", "A1", [], {}])
    step = lambda: {k: v for k, v in (("n", pick([0, 0, 2, 1.5, "x"])), ("at", pick([[], [[1, 2]], [[1], [2, "x", 3]], [5], "y"])), ("zero", value())) if rng.random() < 0.6}
    doc = {k: v for k, v in (("id", pick(["ab", "abc", value()])), ("kind", pick(["a", 1, value()])), ("from", value()), ("to", value()), ("odd", 1)) if rng.random() < 0.7}
    if rng.random() < 0.9:
        doc["steps"] = [pick([step(), step(), value()]) for _ in range(rng.randrange(5))] if rng.random() < 0.9 else value()
    return doc if rng.random() < 0.95 else value()


def test_breaches_against_a_plain_reading(spark):
    rng = random.Random(6)
    docs = [document(rng) for _ in range(250)]
    rows = spark.createDataFrame([*((k, json.dumps(d)) for k, d in enumerate(docs)), (900, "{"), (901, None)], "k int, t string")
    got = sorted(tuple(r) for r in documents.nested_breaches(rows, "k", "t", SCHEMA).collect())
    want = sorted([(k, *b) for k, d in enumerate(docs) for b in plain(SCHEMA, d)] + [(900, "$", "is no document"), (901, "$", "is no document")])
    assert got == want and len({rule for _, _, rule in want}) > 14
