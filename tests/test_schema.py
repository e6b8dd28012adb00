"""JSON schemas and rewards, against values worked out by hand."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import schema as S

BOOK = {"type": "object", "properties": {"title": {"type": "string", "minLength": 2}, "pages": {"type": "integer", "minimum": 1}, "tags": {"type": "array", "items": {"enum": ["a", "b"]}, "maxItems": 2}}, "required": ["title", "pages"], "additionalProperties": False}


@pytest.mark.parametrize(
    ("value", "bad"),
    [
        ({"title": "ok", "pages": 3}, 0), ({"title": "o", "pages": 3}, 1), ({"pages": 0}, 2), ({}, 2), ([], 1), ({"title": "ok", "pages": 2.0}, 0), ({"title": "ok", "pages": True}, 1), ({"title": "ok", "pages": 1, "x": 1, "y": 2}, 1),
        ({"title": "ok", "pages": 1, "tags": ["a", "z", "q"]}, 3), ("text", 1), (None, 1),
    ],
)
def test_violations(value, bad):
    assert S.Validator(BOOK).count(BOOK, value) == bad


@pytest.mark.parametrize(
    ("schema", "value", "bad"),
    [
        ({"anyOf": [{"type": "string"}, {"minimum": 5}]}, 3, 1), ({"anyOf": [{"type": "string"}, {"minimum": 5}]}, 7, 0), ({"oneOf": [{"minimum": 1}, {"maximum": 9}]}, 5, 1), ({"not": {"type": "null"}}, None, 1), ({"allOf": [{"minimum": 4}, {"multipleOf": 3}]}, 2, 2),
        ({"const": 1}, 1.0, 0), ({"const": 1}, True, 1), ({"enum": [[1, 2]]}, [1, 2], 0), ({"uniqueItems": True}, [1, 1.0], 1), ({"contains": {"const": 2}}, [1, 3], 1), ({"items": [{"type": "string"}], "additionalItems": False}, [1, 2], 2),
        ({"if": {"minimum": 5}, "then": {"multipleOf": 5}, "else": {"maximum": 2}}, 7, 1), ({"if": {"minimum": 5}, "then": {"multipleOf": 5}, "else": {"maximum": 2}}, 3, 1), ({"dependencies": {"a": ["b", "c"]}}, {"a": 1}, 2), ({"propertyNames": {"maxLength": 1}}, {"ab": 1, "c": 2}, 1),
        ({"patternProperties": {"^n": {"type": "number"}}, "additionalProperties": {"type": "string"}}, {"n1": "x", "s": 1, "t": "y"}, 2), ({"definitions": {"p": {"minimum": 3}}, "properties": {"x": {"$ref": "#/definitions/p"}}}, {"x": 1}, 1),
        ({"exclusiveMinimum": 3}, 3, 1), ({"pattern": "^a"}, "ba", 1), (False, 1, 1), (True, 1, 0), ({"multipleOf": 0.1}, 0.3, 0),
    ],
)
def test_keywords(schema, value, bad):
    assert S.Validator(schema).count(schema, value) == bad


def test_schemas():
    for good in (True, {}, BOOK, {"items": [{}, True]}, {"type": ["string", "null"]}):
        assert S.is_schema(good)
    for bad in (1, None, {"type": "text"}, {"required": "a"}, {"minLength": -1}, {"properties": {"a": 5}}, {"enum": 3}, {"anyOf": []}, {"pattern": "("}, {"multipleOf": 0}, {"required": ["a", "a"]}):
        assert not S.is_schema(bad)


def test_rewards(spark):
    s = json.dumps(BOOK)
    checks = S.declared_checks(BOOK)
    assert checks == 3 + 2 + 1 + 1 + 1 + 2  # properties, required, additionalProperties, minLength, minimum, maxItems and enum
    rows = [
        ('{"title": "ok", "pages": 3}', False, 2, 1.0, 1.0, 1.0), ('x\n```json\n{"title": "ok", "pages": 3}\n```', False, 2, 0.2, 1.0, 1.0), ('```\n{"title": "ok"}\n```', True, 2, 1.0, 0.5, 0.75 * 0.5 * (1 - 1 / checks)), ("{}", False, 2, 1.0, 0.0, 0.0),
        ("no", False, 2, 0.0, 0.0, 0.0), ("[]", False, 0, 1.0, 0.0, 0.0), ('[{"a": 1}, {"a": 1, "b": 2}]', False, 3, 1.0, 0.5, 0.0), ('```json {"a":1}```', True, 1, 0.0, 0.0, 0.0), (None, False, 1, None, None, None),
    ]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, t string, fenced boolean, n int, a double, b double, c double")
    got = df.select("i", "a", "b", "c", S.format_reward("t", "fenced").alias("x"), S.fields_reward("t", "n").alias("y"), S.schema_reward("t", F.lit(s)).alias("z")).orderBy("i").collect()
    for r in got:
        assert (r.x, r.y, r.z) == (r.a, pytest.approx(r.b) if r.b is not None else None, pytest.approx(r.c) if r.c is not None else None), r
    array = json.dumps({"type": "array", "minItems": 2, "items": {"required": ["k"]}})
    one = spark.createDataFrame([('[{"k": 1}]',)], "t string").select(S.schema_reward("t", F.lit(array)).alias("x")).first().x
    assert one == pytest.approx(0.75 * 0.5 * (1 - 1 / (2 + 1)))
    ok = spark.createDataFrame([(s,), ('{"$ref": "#"}',), ('{"a": {"$ref": "#"}}',), ("no",), (None,)], "t string").select(S.schema_is_valid("t").alias("x")).collect()
    assert [r.x for r in ok] == [True, False, False, False, False]
