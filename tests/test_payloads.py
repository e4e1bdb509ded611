"""Payloads of open shape: unknown fields, other types, broken texts."""

import json

from ledgerlens.sources.payloads import open_payloads, payload_schema

FIELDS = {"score": ("$.scores.overall", "double"), "first": ("$.ids[0]", "bigint"), "key": ("$.id", "string")}


def test_known_and_other_fields(spark):
    given = [
        (1, '{"id": "a", "scores": {"overall": 7.5, "clarity": 3}, "ids": [4, 5], "new": {"deep": [1, null]}, "flag": true}'),
        (2, '{"id": 12, "scores": {"overall": "high"}, "more": null}'), (3, "[1, 2]"), (4, "7"), (5, '{"id": "x"'), (6, None), (7, ""), (8, "{}"),
        (9, '{"a b": "ü\\n", "valid": 1, "other": 2}'),
    ]
    df = spark.createDataFrame(given, "n int, payload string")
    found = {r.n: r for r in open_payloads(df, "payload", FIELDS, ["n"]).collect()}
    assert [found[i].valid for i in range(1, 10)] == [True, True, True, True, False, False, False, True, True]
    assert (found[1].score, found[1].first, found[1].key) == (7.5, 4, "a")
    assert {k: json.loads(v) for k, v in found[1].other.items()} == {"new": {"deep": [1, None]}, "flag": True}
    # Values of another type are NULL where they can't be cast.
    assert (found[2].score, found[2].first, found[2].key) == (None, None, "12") and set(found[2].other) == {"more"}
    assert found[3].other is None and found[4].other is None and found[5].other is None and found[8].other == {}
    assert {k: json.loads(v) for k, v in found[9].other.items()} == {"a b": "ü\n", "valid": 1, "other": 2}
    assert open_payloads(df.limit(0), "payload", FIELDS).count() == 0


def test_one_shape_for_all(spark):
    df = spark.createDataFrame([('{"a": 1}',), ('{"a": 2, "b": {"c": "x"}}',), ("{",), (None,)], "payload string")
    row = payload_schema(df, "payload").first()
    assert (row.n_rows, row.n_valid, row.schema) == (4, 2, "OBJECT<a: BIGINT, b: OBJECT<c: STRING>>")
    assert payload_schema(df.limit(0), "payload").first().n_rows == 0
