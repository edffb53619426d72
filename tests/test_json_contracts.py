"""Compiled contracts against a plain validator, on messages that are broken one way at a time."""

import copy
import json
import re

import pytest
from pyspark.sql import functions as F

from veilframe.operators import json_contracts, messages
from veilframe.operators.json_contracts import Contracts, ContractError

IDS, SLOT = "0123456789abcdef" * 2, "2026-01-01T04:00:00Z"
ENVELOPE = {"schema_version": "1", "event_type": "row.flat", "event_id": IDS, "idempotency_key": IDS, "dataset": "d", "logical_date": "2026-01-01", "run_slot": SLOT, "trace_id": "t", "run_id": "r", "try_number": 1, "key": "k", "producer": "p", "produced_at": SLOT}
FLAT = {"envelope": ENVELOPE, "payload": {"a": 1, "b": None}}
SEALED = {"envelope": ENVELOPE | {"event_type": "row.encrypted"}, "payload": {"n_encrypted": "enc:v1:AAAA", "n_blind_index": "x", "m_encrypted": None}}
VERDICT = {
    "envelope": ENVELOPE | {"event_type": "run.verdict", "key": None}, "signature": "s",
    "payload": {"proceed": True, "status": "complete", "reasons": [], "stages": {"load": {"ok": True, "reported": True}}, "computed_at": SLOT, "data_window": {"start": None, "end": "x", "source": "unknown"},
                "outputs": {"warehouse_table": "w", "hive_table": None, "pdf": None, "rows_published": 2, "rows_loaded": None, "topics": {"a": "b"}}},
}
STAGE = {"trace_id": "t", "stage": "load", "inserted": 1, "updated": 0, "run_id": "r", "dataset": "d"}
SCHEMAS = messages.CONTRACTS.schemas


def plain(schema, value, file):
    """Whether a value is as a schema says, in plain code."""
    kinds = {"string": str, "object": dict, "array": list, "boolean": bool, "null": type(None)}

    def isa(kind):
        number = isinstance(value, int | float) and not isinstance(value, bool)
        return number and (kind == "number" or value == int(value)) if kind in ("number", "integer") else isinstance(value, kinds[kind])

    if isinstance(schema, bool):
        return schema
    props, patterns = schema.get("properties", {}), schema.get("patternProperties", {})
    for k, x in schema.items():
        ok = True
        if k == "$ref":
            name, _, pointer = x.partition("#")
            sub = SCHEMAS[name or file]
            for step in pointer.split("/")[1:]:
                sub = sub[step]
            ok = plain(sub, value, name or file)
        elif k == "type":
            ok = any(isa(t) for t in ([x] if isinstance(x, str) else x))
        elif k in ("const", "enum"):
            ok = any(value == y and isinstance(value, bool) == isinstance(y, bool) for y in ([x] if k == "const" else x))
        elif k == "allOf":
            ok = all(plain(s, value, file) for s in x)
        elif k == "not":
            ok = not plain(x, value, file)
        elif k == "if":
            ok = plain(schema.get("then" if plain(x, value, file) else "else", True), value, file)
        elif isa("string") and k in ("pattern", "minLength"):
            ok = bool(re.search(x, value)) if k == "pattern" else len(value) >= x
        elif isa("string") and k == "format":
            ok = bool(re.fullmatch(r"\d{4}-(0[1-9]|1[0-2])-(0[1-9]|[12]\d|3[01])", value))
        elif isa("number") and k == "minimum":
            ok = value >= x
        elif isa("array") and k == "items":
            ok = all(plain(x, y, file) for y in value)
        elif isa("object"):
            if k == "required":
                ok = all(n in value for n in x)
            elif k == "properties":
                ok = all(plain(s, value[n], file) for n, s in x.items() if n in value)
            elif k == "propertyNames":
                ok = all(plain(x, n, file) for n in value)
            elif k == "patternProperties":
                ok = all(plain(s, y, file) for p, s in x.items() for n, y in value.items() if re.search(p, n))
            elif k == "additionalProperties":
                ok = all(plain(x, y, file) for n, y in value.items() if n not in props and not any(re.search(p, n) for p in patterns))
        if not ok:
            return False
    return True


def broken(value):
    """The value, and it with each place in turn left out or replaced by something odd."""
    yield value

    def places(v, path=()):
        for k in list(v) if isinstance(v, dict) else []:
            yield (*path, k)
            yield from places(v[k], (*path, k))

    for path in list(places(value)):
        for odd in ("leave out", None, "", "x", 0, -1, 1.5, 2.0, True, [], ["a", 1], {}, {"z": 1}):
            other = copy.deepcopy(value)
            at = other
            for step in path[:-1]:
                at = at[step]
            if odd == "leave out":
                del at[path[-1]]
            else:
                at[path[-1]] = odd
            yield other
    for extra in ("z_masked", "z_encrypted", "z"):
        yield value | {"payload": value.get("payload", {}) | {extra: "v"}}
        yield value | {"envelope": value.get("envelope", {}) | {extra: "v"}}


def test_messages_and_stage_events_against_a_plain_validator(spark):
    cases = [(name, value) for name, base in (("row_flat", FLAT), ("row_encrypted", SEALED), ("run_verdict", VERDICT), ("stage_event", STAGE)) for value in broken(base)]
    for name in sorted({n for n, _ in cases}):
        own = [v for n, v in cases if n == name]
        rows = spark.createDataFrame([(i, json.dumps(v)) for i, v in enumerate(own)], "id long, value string")
        got = {r.id: r.bad for r in messages.CONTRACTS.plan(f"{name}.schema.json").onto(rows, "value", "bad").collect()}
        want = {i: plain(SCHEMAS[f"{name}.schema.json"], v, f"{name}.schema.json") for i, v in enumerate(own)}
        assert {i: not codes for i, codes in got.items()} == want
        assert 1 <= sum(want.values()) < len(own) / 2
        by_column = rows.select("id", messages.CONTRACTS.plan(f"{name}.schema.json").column(F.col("value")).alias("bad")).collect()
        assert {r.id: r.bad for r in by_column} == got


def test_the_event_type_selects_the_contract(spark):
    texts = [json.dumps(x) for x in (FLAT, SEALED, VERDICT, FLAT | {"envelope": ENVELOPE | {"event_type": "other"}}, FLAT | {"payload": {"a_masked": 1}}, VERDICT | {"signature": None}, {"payload": {}})]
    texts += ["{", "[]", "null", '"text"', None, '{"envelope": {}, "envelope": {}}']
    got = messages.judged(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, value string")).orderBy("id").collect()
    fields = sorted(ENVELOPE)
    assert [r.problems for r in got] == [[], [], [], ["event_type"], ["flat_payload"], ["signature"], ["envelope"], ["not_json"], ["value"], ["value"], ["value"], ["not_json"], ["not_json"]]
    empty = messages.judged(spark.createDataFrame([('{"envelope": {}, "payload": {}}',)], "value string")).first().problems
    assert empty == fields


def test_a_changed_file_changes_the_codes(spark, tmp_path):
    for name, schema in SCHEMAS.items():
        (tmp_path / name).write_text(json.dumps(schema))
    rows = spark.createDataFrame([(json.dumps(FLAT),)], "value string")
    assert messages.judged(rows, contracts=Contracts.read(tmp_path)).first().problems == []
    stricter = copy.deepcopy(SCHEMAS["row_flat.schema.json"])
    stricter["allOf"][1]["properties"]["payload"] |= {"required": ["price"], "x-code": "no_price"}
    (tmp_path / "row_flat.schema.json").write_text(json.dumps(stricter))
    assert messages.judged(rows, contracts=Contracts.read(tmp_path)).first().problems == ["no_price"]


def test_what_cannot_be_compiled_is_refused(spark):
    for schema in ({"unevaluatedProperties": False}, {"type": "date"}, {"$ref": "missing.json"}, {"const": {"a": 1}}, {"properties": {"a": {"$ref": "a.json"}}}):
        with pytest.raises(ContractError):
            Contracts({"a.json": schema}).plan("a.json")
    with pytest.raises(ContractError):
        Contracts({}).plan("a.json")
    with pytest.raises(ContractError, match="/inserted: minimum; /stage|/inserted"):
        json_contracts.validate(spark, STAGE | {"inserted": -1}, messages.CONTRACTS, messages.STAGE_SCHEMA)
    json_contracts.validate(spark, STAGE, messages.CONTRACTS, messages.STAGE_SCHEMA)


def test_further_keywords(spark):
    schema = {
        "anyOf": [{"required": ["a"]}, {"required": ["b"]}], "oneOf": [{"required": ["c"]}, {"required": ["d"]}], "dependentRequired": {"a": ["e"]},
        "properties": {"a": {"multipleOf": 0.5, "exclusiveMaximum": 3}, "b": {"contains": {"const": 1}, "maxItems": 2}, "f": {"enum": [1, "x", None, False]}, "g": {"minProperties": 1}, "h": False},
    }
    cases = {'{"a": 1, "c": 1, "e": 1}': [], '{"b": [1], "d": 0}': [], '{"c": 1}': ["value"], '{"b": [1], "c": 1, "d": 1}': ["value"], '{"a": 1, "c": 1}': ["e"], '{"a": 1.2, "e": 0, "c": 1}': ["a"], '{"a": 3, "e": 0, "c": 1}': ["a"],
             '{"b": [0], "c": 1}': ["b"], '{"b": [1, 1, 1], "c": 1}': ["b"], '{"b": [1], "c": 1, "f": 1.0, "g": {"z": 0}}': [], '{"b": [1], "c": 1, "f": true}': ["f"], '{"b": [1], "c": 1, "g": {}}': ["g"], '{"b": [1], "c": 1, "h": null}': ["h"]}
    rows = spark.createDataFrame([(t,) for t in cases], "value string")
    assert {r.value: r.bad for r in Contracts({"s.json": schema}).plan("s.json").onto(rows, "value", "bad").collect()} == cases


def test_what_breaks_readers_of_an_older_schema():
    old = {"required": ["a", "b"], "properties": {"a": {"type": "string"}, "b": {"enum": [1, 2]}, "c": {}, "d": {"properties": {"e": {}}}, "f": {"const": 1}, "g": {"type": "string"}}}
    new = {"required": ["a"], "properties": {"a": {"type": "integer"}, "b": {"enum": [1]}, "d": {"properties": {}}, "f": {"const": 2}, "g": {"type": ["string", "null"]}, "h": {}}}
    assert sorted(messages.incompatible(old, new)) == sorted(["/b: no longer required", "/a: type string became integer", "/b: enum values removed", "/c: removed", "/d/e: removed", "/f: const changed"])
