"""Contract checks by the payload's whole type agree with the checks path by path."""

import json

from pyspark.sql import functions as F

from crowdpulse.operators import quality as Q

CONTRACT = (("id", "string", True, False), ("n", "integer", True, True), ("x", "number", False, False), ("tags", "array", False, True),
            ("flag", "boolean", True, False), ("dev", "object", True, False), ("dev.type", "string", True, False), ("dev.os", "string", False, True))
GOOD = {"id": "a", "n": 1, "x": 1.5, "tags": ["q"], "flag": True, "dev": {"type": "tv", "os": None}}


def payloads():
    yield json.dumps(GOOD)
    for k in GOOD:
        yield json.dumps({a: b for a, b in GOOD.items() if a != k})
        for v in (None, "t", 3, 2.5, True, [], [1, "a"], [[1]], {}, {"type": "z"}, {"os": "z"}, {"type": 3}, {"type": "z", "more": 1}):
            yield json.dumps({**GOOD, k: v})
    yield json.dumps({**GOOD, "other": 1})
    yield json.dumps({"dev": GOOD["dev"], "flag: BOOLEAN, id: STRING, n": 3})
    yield from ('{"id":', "[]", "3", "null", '"x"', "{}", None, '{"id":"a","id":"b"}')


def test_whole_types_agree_with_paths(spark, monkeypatch):
    raw = spark.createDataFrame([(p,) for p in payloads()], "value string")
    enums = {"id": ("a", "b"), "dev.type": ("tv", "web")}
    got = Q.validate_contract(raw, CONTRACT, enums=enums).collect()
    monkeypatch.setattr(Q, "_valid_type", lambda contract: "nothing")
    assert sorted(map(str, got)) == sorted(map(str, Q.validate_contract(raw, CONTRACT, enums=enums).collect()))


def test_usual_payloads_are_known_by_their_type(spark):
    usual = [GOOD, {**GOOD, "n": None}, {**GOOD, "tags": None}, {k: v for k, v in GOOD.items() if k not in ("x", "tags")}, {**GOOD, "x": 3}]
    raw = spark.createDataFrame([(json.dumps(p),) for p in usual], "value string")
    typ = F.schema_of_variant(F.try_parse_json("value"))
    assert raw.where(typ.rlike(f"^{Q._valid_type(CONTRACT)}$")).count() == len(usual)
