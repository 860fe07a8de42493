"""Nested values: schemas, canonical JSON and rewritten strings, against plain Python."""

import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, LongType, MapType, StringType, StructField, StructType

from millrace.functions import nested
from millrace.functions.json_schema import SchemaError, text_errors


def errors(spark, schema, *docs):
    rows = [(i, d if isinstance(d, str) or d is None else json.dumps(d)) for i, d in enumerate(docs)]
    found = spark.createDataFrame(rows, "i int, b string").select("i", text_errors(F.col("b"), schema).alias("e")).orderBy("i").collect()
    return [[tuple(e) for e in r.e] for r in found]


def test_caption_schema(spark):
    schema = {
        "type": "object",
        "required": ["id", "hash", "quality", "stage"],
        "properties": {
            "id": {"type": "string"},
            "hash": {"type": "string", "pattern": "^[a-f0-9]{4}$"},
            "concept": {"type": ["string", "null"]},
            "quality": {"type": "object", "required": ["usable", "risks"], "properties": {"usable": {"type": "boolean"}, "risks": {"type": "array", "items": {"type": "string"}}}},
            "stage": {"enum": ["adult", 3, None, [1, {"a": 2}]]},
        },
    }
    good = {"id": "a", "hash": "00ff", "concept": None, "quality": {"usable": True, "risks": []}, "stage": "adult", "more": 1}
    bad = {"id": 1, "hash": "00FF", "concept": 2.5, "quality": {"usable": "yes", "risks": ["a", 1, None]}, "stage": "child"}
    got = errors(spark, schema, good, bad, {}, good | {"stage": [1, {"a": 2}]}, good | {"stage": 3.0}, good | {"stage": None}, good | {"quality": None}, "{bad", None, [])
    assert got[0] == got[3] == got[4] == got[5] == []
    assert got[1] == [("/id", "type"), ("/hash", "pattern"), ("/concept", "type"), ("/quality/usable", "type"), ("/quality/risks/1", "type"), ("/quality/risks/2", "type"), ("/stage", "enum")]
    assert got[2] == [("/id", "required"), ("/hash", "required"), ("/quality", "required"), ("/stage", "required")]
    assert got[6] == [("/quality", "type")] and got[7] == got[8] == [("", "unreadable")] and got[9] == [("", "type")]


def test_keywords(spark):
    schema = {
        "properties": {
            "a/b": {"const": True},
            "n": {"type": "integer", "minimum": 1, "exclusiveMaximum": 10, "multipleOf": 2},
            "s": {"minLength": 2, "maxLength": 3},
            "l": {"minItems": 1, "maxItems": 3, "uniqueItems": True, "contains": {"type": "integer"}, "prefixItems": [{"type": "string"}], "items": {"type": "integer"}},
            "o": {"minProperties": 1, "maxProperties": 2, "propertyNames": {"pattern": "^[a-z]+$"}, "additionalProperties": {"type": "string"}},
            "x": {"anyOf": [{"type": "string"}, {"minimum": 5}]},
            "y": {"oneOf": [{"type": "integer"}, {"type": "number"}]},
            "z": {"not": {"type": "string"}, "allOf": [{"type": "number"}, {"maximum": 3}]},
            "w": {"if": {"type": "string"}, "then": {"minLength": 2}, "else": {"$ref": "#/$defs/no"}},
            "t": False,
        },
        "additionalProperties": False,
        "dependentRequired": {"s": ["n"]},
        "$defs": {"no": {"type": "null"}},
    }
    good = {"a/b": True, "n": 4.0, "s": "éé", "l": ["a", 1, 2], "o": {"k": "v"}, "x": 6, "y": 1.5, "z": 2, "w": None}
    bad = {"a/b": 1, "n": 11, "s": "a", "l": ["a", "b", "b", 1], "o": {"k~/": 1, "B": "v", "c": "v"}, "x": 4, "y": 1, "z": "q", "w": "w", "t": 0, "e": {}}
    got = errors(spark, schema, good, bad, {"s": "abc"}, {"l": []}, {"o": {}}, {"n": 0})
    assert got[0] == []
    want = ["/a~1b const", "/n exclusiveMaximum", "/n multipleOf", "/s minLength", "/l maxItems", "/l uniqueItems", "/l/1 type", "/l/2 type", "/o maxProperties", "/o/B propertyNames", "/o/k~0~1 propertyNames", "/o/k~0~1 type", "/x anyOf", "/y oneOf", "/z not", "/z type", "/w minLength", "/t false", "/e additionalProperties"]
    assert sorted(f"{p} {k}" for p, k in got[1]) == sorted(want)
    assert got[2] == [("/n", "dependentRequired")] and got[3] == [("/l", "minItems"), ("/l", "contains")] and got[4] == [("/o", "minProperties")] and got[5] == [("/n", "minimum")]


@pytest.mark.parametrize("schema", [{"unknown": 1}, {"type": "thing"}, {"$ref": "#/$defs/a", "$defs": {"a": {"items": {"$ref": "#/$defs/a"}}}}, {"$ref": "other.json"}, {"$ref": "#/nowhere"}])
def test_schemas_that_cannot_be_compiled(schema):
    with pytest.raises(SchemaError):
        text_errors(F.lit("{}"), schema)


# -- canonical JSON ------------------------------------------------------------------------------------

TEXTS = ["", "plain", 'q"\\/', "é ñ 漢", "😀", "\n\t\r\b\f\x00\x1f\x7f", "a/b/c"]


def random_kind(rng, depth=0):
    kind = rng.choice(("struct", "array", "map", "text", "long", "double", "bool") if depth < 3 else ("text", "long", "double", "bool"))
    if kind == "struct":
        return StructType([StructField(n, random_kind(rng, depth + 1)) for n in rng.sample(["b", "a", "Z", "é", "a_1", "sp ace"], rng.randint(1, 4))])
    if kind == "array":
        return ArrayType(random_kind(rng, depth + 1))
    if kind == "map":
        return MapType(StringType(), random_kind(rng, depth + 1))
    return {"text": StringType(), "long": LongType(), "double": DoubleType(), "bool": BooleanType()}[kind]


def random_value(rng, kind):
    if rng.random() < 0.1:
        return None
    if isinstance(kind, StructType):
        return {f.name: random_value(rng, f.dataType) for f in kind}
    if isinstance(kind, ArrayType):
        return [random_value(rng, kind.elementType) for _ in range(rng.randint(0, 3))]
    if isinstance(kind, MapType):
        return {k: random_value(rng, kind.valueType) for k in rng.sample(TEXTS, rng.randint(0, 3))}
    if isinstance(kind, StringType):
        return rng.choice(TEXTS)
    if isinstance(kind, LongType):
        return rng.choice((0, -1, 2**62))
    if isinstance(kind, BooleanType):
        return rng.random() < 0.5
    return rng.choice((0.0, -0.0, 1.0, -2.5, 1e16, 123456789012345680.0, 1e-4, 1.5e-5, 2e-3, 5e-324, 1.7976931348623157e308, 0.1, 1 / 3, 2.0**-44, 1e22, 1e23, 9007199254740993.0, rng.uniform(-1e6, 1e6), float("inf"), float("nan")))


def test_canonical_json_of_random_values(spark):
    for seed in range(6):
        rng = random.Random(seed)
        kind = StructType([StructField("v", StructType([StructField("x", random_kind(rng)), StructField("w", random_kind(rng))]))])
        rows = [{"v": random_value(rng, kind["v"].dataType)} for _ in range(40)]
        got = [r[0] for r in spark.createDataFrame(rows, kind).coalesce(1).select(nested.canonical_json(F.col("v"), kind["v"].dataType)).collect()]
        want = [json.dumps(r["v"], sort_keys=True, separators=(",", ":")) for r in rows]
        assert got == want


def test_doubles_have_the_fewest_digits(spark):
    rng = random.Random(1)
    values = [rng.uniform(-1, 1) * 10.0 ** rng.randint(-30, 30) for _ in range(3000)] + [2.0**k for k in range(-1070, 1020, 7)] + [k / 100 for k in range(-500, 500)]
    got = spark.createDataFrame([(v,) for v in values], "v double").coalesce(1).select(nested.json_double(F.col("v"))).collect()
    digits = lambda t: len(t.split("e")[0].replace(".", "").strip("-0"))
    other = [(r[0], v) for r, v in zip(got, values) if r[0] != json.dumps(v)]
    assert len(other) < 0.005 * len(values)
    assert all(float(t) == v and digits(t) - digits(json.dumps(v)) in (0, 1) and digits(t) >= 16 for t, v in other)


def test_rewritten_strings(spark):
    kind = "doc struct<`/a`: string, l: array<struct<p: string, n: int>>, m: map<string, array<string>>, n: struct<x: string>>"
    doc = ("/a/b/c", [("/a", 1), ("/ab", 2), (None, 3)], {"/a": ["/a/x", "plain"], "k": None}, None)
    df = spark.createDataFrame([(doc,), (None,)], kind)
    got = nested.rewrite_roots(df, ["doc"], {"/a": "A", "/a/b": "B/"}, "kept", "/ab").collect()
    assert got[0].doc.asDict(True) == {"/a": "B//c", "l": [{"p": "A", "n": 1}, {"p": "kept/ab", "n": 2}, {"p": None, "n": 3}], "m": {"/a": ["A/x", "plain"], "k": None}, "n": None}
    assert got[1].doc is None and nested.rewrite_roots(df, ["doc"], {}).schema == df.schema
    assert nested.replace_strings(df, ["doc"], {"/a": "/b", "/b/b": "x"}).first().doc["/a"] == "x/c"
