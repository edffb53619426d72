"""JSON Schema files compiled to Spark SQL: what is wrong with each JSON text of a column.

A schema becomes a plan of two parts: the values it looks at, by depth, each extracted once
as a VARIANT with its type, and the faults, each a condition on them. On a DataFrame every
depth is one projection, so conditions are plain generated code; the same plan is also one
column expression, in which a depth is a variable of a higher-order function. Python runs on
no executor. A fault's code is the nearest ``x-code`` of the schema, else the name of the
property. Values are absent (SQL NULL) or present, and JSON's null is a value. Keywords that
the compiler does not know are refused rather than ignored, as are schemas that contain
themselves.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Callable
from dataclasses import dataclass, field, replace
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Keywords that say nothing about a value, and the one that names a code.
ANNOTATIONS = frozenset("$schema $id $comment $defs title description default examples deprecated readOnly writeOnly x-code".split())
NOT_JSON = "not_json"


class ContractError(ValueError):
    """A schema that cannot be compiled, or a value that breaks its contract."""


def quoted(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


@dataclass(frozen=True)
class Fault:
    path: str
    keyword: str
    code: str
    wrong: str  # a condition; null counts as false

    def only(self, condition: str) -> Fault:
        return replace(self, wrong=f"({condition}) AND ({self.wrong})")


@dataclass
class Plan:
    """Extracted values by depth, and the faults; ``⟦name⟧`` in a text stands for such a value."""

    depths: dict[int, dict[str, str]] = field(default_factory=dict)
    faults: list[Fault] = field(default_factory=list)

    def value(self, sql: str, depth: int) -> str:
        """The name of a value, the same for the same text."""
        known = self.depths.setdefault(depth, {})
        for name, text in known.items():
            if text == sql:
                return f"⟦{name}⟧"
        known[name := f"d{depth}_{len(known)}"] = sql
        return f"⟦{name}⟧"

    def codes(self, by_path: bool) -> str:
        """An array of codes, for texts that are JSON."""
        shown = lambda f: quoted(f"{f.path or '/'}: {f.keyword}" if by_path else f.code)
        found = [f"CASE WHEN {f.wrong} THEN {shown(f)} END" for f in self.faults] or ["CAST(NULL AS STRING)"]
        return f"CASE WHEN ⟦d0_0⟧ IS NULL THEN array('{NOT_JSON}') ELSE array_sort(array_distinct(array_compact(array({', '.join(found)})))) END"

    def onto(self, df: DataFrame, raw: str, name: str, by_path: bool = False) -> DataFrame:
        """``df`` with the codes of the JSON texts of its column ``raw``, sorted, as column ``name``."""
        own, prefix = df.columns, "__contract_"
        here = lambda sql: re.sub(r"⟦(\w+)⟧", lambda m: f"`{raw}`" if m[1] == "raw" else f"`{prefix}{m[1]}`", sql)
        out = df
        for depth in sorted(self.depths):
            out = out.selectExpr("*", *(f"{here(sql)} AS `{prefix}{n}`" for n, sql in self.depths[depth].items()))
        return out.selectExpr(*(f"`{c}`" for c in own if c != name), f"{here(self.codes(by_path))} AS `{name}`")

    def sql(self, raw: str = "raw", by_path: bool = False) -> str:
        """The same as one expression on the column or variable ``raw``."""
        place = {n: f"c{depth}.{n}" for depth, names in self.depths.items() for n in names} | {"raw": raw}
        here = lambda sql: re.sub(r"⟦(\w+)⟧", lambda m: place[m[1]], sql)
        text = here(self.codes(by_path))
        for depth in sorted(self.depths, reverse=True):
            fields = ", ".join(f"{here(sql)} AS {n}" for n, sql in self.depths[depth].items())
            text = f"transform(array(struct({fields})), c{depth} -> {text})[0]"
        return text

    def column(self, raw: Column, by_path: bool = False) -> Column:
        """The same as a column, by a temporary SQL function of the active session."""
        body = self.sql(by_path=by_path)
        name = f"contract_{zlib.crc32(body.encode()):08x}"
        SparkSession.active().sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(raw STRING) RETURNS ARRAY<STRING> RETURN {body}")
        return F.call_function(name, raw)


@dataclass(frozen=True)
class _At:
    """Where in a value and in the schemas the compiler is. ``depth`` is None inside of an element, where values are written out."""

    plan: Plan
    file: str
    v: str
    kind: str
    depth: int | None
    path: str
    explicit: str | None  # the code that an x-code above gives
    name: str
    within: tuple[str, ...]
    nested: int = 0  # how many elements it is inside of

    def fault(self, keyword: str, wrong: str) -> Fault:
        return Fault(self.path, keyword, self.explicit or self.name, f"{self.v} IS NOT NULL AND coalesce({wrong}, false)")

    def named(self, name: str, schema: object = None) -> _At:
        explicit = schema.get("x-code", self.explicit) if isinstance(schema, dict) else self.explicit
        return replace(self, path=f"{self.path}/{name}", name=name, explicit=explicit)

    def isa(self, kind: str) -> str:
        if kind not in KINDS:
            raise ContractError(f"unknown type {kind!r}")
        return f"({self.fill(KINDS[kind])})"

    def fill(self, template: str, **more: object) -> str:
        """A template with the value as {v}, its kind as {k}, its text as {t} and its number as {n}."""
        for field_, kind in (("t", "string"), ("n", "double")):
            if "{" + field_ + "}" in template:
                more[field_] = self._value(f"try_variant_get({self.v}, '$', '{kind}')", 1)
        return template.format(v=self.v, k=self.kind, **more)

    def property(self, name: str) -> str:
        if "'" in name:
            raise ContractError(f"property names with an apostrophe are not supported: {name}")
        return self._value(f"try_variant_get({self.v}, {quoted(f"$['{name}']")}, 'variant')", 1)

    def _value(self, sql: str, more: int) -> str:
        return sql if self.depth is None else self.plan.value(sql, self.depth + more)

    def below(self, name: str) -> _At:
        v = self.property(name)
        return replace(self.named(name), v=v, kind=self._value(f"schema_of_variant({v})", 2), depth=None if self.depth is None else self.depth + 2)

    def inside(self, v: str) -> _At:
        return replace(self, v=v, kind=f"schema_of_variant({v})", depth=None, path=f"{self.path}/*", nested=self.nested + 1)

    def exists(self, array: str, wrong: Callable[[str], str]) -> str:
        e = f"e{self.nested}"
        return f"exists({self.fill(array)}, {e} -> {wrong(e)})"


ENTRIES, ELEMENTS = "map_entries(try_variant_get({v}, '$', 'map<string,variant>'))", "try_variant_get({v}, '$', 'array<variant>')"
IS_NUMBER = "{k} IN ('BIGINT', 'DOUBLE', 'FLOAT') OR {k} LIKE 'DECIMAL%'"
KINDS = {
    "string": "{k} = 'STRING'", "boolean": "{k} = 'BOOLEAN'", "null": "{k} = 'VOID'", "object": "{k} LIKE 'OBJECT%'", "array": "{k} LIKE 'ARRAY%'", "number": IS_NUMBER,
    "integer": "{k} = 'BIGINT' OR ({k} LIKE 'DECIMAL%' AND {t} RLIKE '^-?[0-9]+([.]0+)?$') OR ({k} IN ('DOUBLE', 'FLOAT') AND {n} = floor({n}))",
}
#: Assertions on one value: keyword -> (the type they are about, when a value of it is wrong).
SIMPLE: dict[str, tuple[str, str]] = {
    "pattern": ("string", "NOT {t} RLIKE {x}"), "minLength": ("string", "length({t}) < {x}"), "maxLength": ("string", "length({t}) > {x}"),
    "minimum": ("number", "{n} < {x}"), "maximum": ("number", "{n} > {x}"), "exclusiveMinimum": ("number", "{n} <= {x}"), "exclusiveMaximum": ("number", "{n} >= {x}"),
    "multipleOf": ("number", "{n} / {x} <> floor({n} / {x})"), "minItems": ("array", f"size({ELEMENTS}) < {{x}}"), "maxItems": ("array", f"size({ELEMENTS}) > {{x}}"),
    "minProperties": ("object", f"size({ENTRIES}) < {{x}}"), "maxProperties": ("object", f"size({ENTRIES}) > {{x}}"),
}
FORMATS = {"date": "try_to_timestamp({t}, 'yyyy-MM-dd') IS NULL", "date-time": "try_to_timestamp({t}) IS NULL"}


def _any(conditions: list[str]) -> str:
    return " OR ".join(f"({c})" for c in conditions) or "false"


def _equals(at: _At, value: object) -> str:
    """Whether a value is a given scalar; 1 and 1.0 are one number, true is none."""
    if value is None:
        return at.isa("null")
    if isinstance(value, bool):
        return f"{at.isa('boolean')} AND try_variant_get({at.v}, '$', 'boolean') = {str(value).lower()}"
    if isinstance(value, int | float):
        return f"{at.isa('number')} AND {at.fill('{n}')} = CAST({value!r} AS DOUBLE)"
    if isinstance(value, str):
        return f"{at.isa('string')} AND {at.fill('{t}')} = {quoted(value)}"
    raise ContractError("const and enum compare scalars only")


class Contracts:
    """A set of schemas by file name, which refer to each other by it."""

    def __init__(self, schemas: dict[str, dict], formats: bool = True):
        self.schemas, self.formats = schemas, formats
        self.keywords: dict[str, Callable[..., list[Fault]]] = {
            "$ref": self._ref, "allOf": self._all, "anyOf": self._some, "oneOf": self._some, "not": self._not, "if": self._branch, "type": self._type, "const": self._enum, "enum": self._enum,
            "required": self._required, "properties": self._properties, "patternProperties": self._keys, "additionalProperties": self._keys, "propertyNames": self._names,
            "items": self._items, "contains": self._contains, "dependentRequired": self._dependent, "format": self._format,
        }

    @classmethod
    def read(cls, folder: str | Path, formats: bool = True) -> Contracts:
        return cls({p.name: json.loads(p.read_text()) for p in sorted(Path(folder).glob("*.json"))}, formats)

    def plan(self, name: str) -> Plan:
        """What one schema looks at and asks for."""
        return self._planned(Plan(), name)[0]

    def selected(self, by: tuple[str, ...], kinds: dict[str, str], default: str) -> Plan:
        """The same by the schema that the text at a place of the value selects, that of ``default`` for what no kind names. What all have in common is checked once."""
        plan, own = Plan(), {}
        for kind, name in [*kinds.items(), (None, default)]:
            (_, at), own[kind] = self._planned(plan, name), plan.faults
            plan.faults = []
        for step in by:
            at = at.below(step)
        chosen = at.fill("{t}")
        other = f"coalesce({chosen}, '') NOT IN ({', '.join(map(quoted, kinds))})"
        seen: dict[Fault, list[str | None]] = {}
        for kind, faults in own.items():
            for f in dict.fromkeys(faults):
                seen.setdefault(f, []).append(kind)
        for f, of in seen.items():
            here = [f"{chosen} = {quoted(k)}" for k in of if k is not None] + [other] * (None in of)
            plan.faults.append(f if len(of) == len(own) else f.only(_any(here)))
        return plan

    def _planned(self, plan: Plan, name: str) -> tuple[Plan, _At]:
        if name not in self.schemas:
            raise ContractError(f"no contract named {name!r}")
        v = plan.value("try_parse_json(⟦raw⟧)", 0)
        at = _At(plan, name, v, plan.value(f"schema_of_variant({v})", 1), 1, "", None, "value", (name,))
        plan.faults += self._faults(self.schemas[name], at)
        return plan, at

    def _faults(self, schema: dict | bool, at: _At) -> list[Fault]:
        if isinstance(schema, bool):
            return [] if schema else [at.fault("false", "true")]
        at = replace(at, explicit=schema.get("x-code", at.explicit))
        out = []
        for keyword, x in schema.items():
            if keyword in SIMPLE:
                kind, wrong = SIMPLE[keyword]
                out.append(at.fault(keyword, f"{at.isa(kind)} AND {at.fill(wrong, x=quoted(x) if isinstance(x, str) else repr(x))}"))
            elif keyword in self.keywords:
                out += self.keywords[keyword](keyword, x, schema, at)
            elif keyword not in ANNOTATIONS and keyword not in ("then", "else"):
                raise ContractError(f"{at.file}{at.path}: keyword {keyword!r} is not supported")
        return out

    def _wrong(self, schema: dict | bool, at: _At) -> str:
        return _any([f.wrong for f in self._faults(schema, at)])

    def _ref(self, keyword, x, schema, at):
        file, _, pointer = x.partition("#")
        file = file.rpartition("/")[2] or at.file
        target = f"{file}#{pointer}" if pointer else file
        if file not in self.schemas:
            raise ContractError(f"{at.file}{at.path}: no contract named {file!r}")
        if target in at.within:
            raise ContractError(f"{target} contains itself")
        found = self.schemas[file]
        for step in pointer.split("/")[1:]:
            found = found[step.replace("~1", "/").replace("~0", "~")]
        return self._faults(found, replace(at, file=file, within=(*at.within, target)))

    def _all(self, keyword, x, schema, at):
        return [f for sub in x for f in self._faults(sub, at)]

    def _some(self, keyword, x, schema, at):
        n = " + ".join(f"CASE WHEN {self._wrong(sub, at)} THEN 0 ELSE 1 END" for sub in x)
        return [at.fault(keyword, f"{n} {'< 1' if keyword == 'anyOf' else '<> 1'}")]

    def _not(self, keyword, x, schema, at):
        return [at.fault("not", f"NOT ({self._wrong(x, at)})")]

    def _branch(self, keyword, x, schema, at):
        fails = self._wrong(x, at)
        return [f.only(f"NOT ({fails})") for f in self._faults(schema.get("then", True), at)] + [f.only(fails) for f in self._faults(schema.get("else", True), at)]

    def _type(self, keyword, x, schema, at):
        return [at.fault("type", f"NOT ({_any([at.isa(k) for k in ([x] if isinstance(x, str) else x)])})")]

    def _enum(self, keyword, x, schema, at):
        return [at.fault(keyword, f"NOT coalesce({_any([_equals(at, value) for value in ([x] if keyword == 'const' else x)])}, false)")]

    def _required(self, keyword, x, schema, at):
        own = schema.get("properties", {})
        return [at.named(f, own.get(f)).fault("required", f"{at.isa('object')} AND {at.property(f)} IS NULL") for f in x]

    def _dependent(self, keyword, x, schema, at):
        return [at.named(f).fault(keyword, f"{at.property(name)} IS NOT NULL AND {at.property(f)} IS NULL") for name, needed in x.items() for f in needed]

    def _properties(self, keyword, x, schema, at):
        return [f for name, sub in x.items() for f in self._faults(sub, at.below(name))]

    def _keys(self, keyword, x, schema, at):
        """Of patternProperties each entry is held against the patterns its name has, of additionalProperties those that nothing else names."""
        known = [f"{{e}}.key = {quoted(n)}" for n in schema.get("properties", {})] + [f"{{e}}.key RLIKE {quoted(p).replace('{', '{{').replace('}', '}}')}" for p in schema.get("patternProperties", {})]
        rules = [(f"NOT ({_any(known)})", x)] if keyword == "additionalProperties" else [(f"{{e}}.key RLIKE {quoted(p).replace('{', '{{').replace('}', '}}')}", sub) for p, sub in x.items()]
        wrong = lambda e: _any([f"{applies.format(e=e)} AND ({self._wrong(sub, at.inside(f'{e}.value'))})" for applies, sub in rules])
        return [at.fault(keyword, f"{at.isa('object')} AND {at.exists(ENTRIES, wrong)}")]

    def _names(self, keyword, x, schema, at):
        return [at.fault(keyword, f"{at.isa('object')} AND {at.exists(ENTRIES, lambda e: self._wrong(x, at.inside(f'CAST({e}.key AS VARIANT)')))}")]

    def _items(self, keyword, x, schema, at):
        return [at.fault(keyword, f"{at.isa('array')} AND {at.exists(ELEMENTS, lambda e: self._wrong(x, at.inside(e)))}")]

    def _contains(self, keyword, x, schema, at):
        return [at.fault(keyword, f"{at.isa('array')} AND NOT {at.exists(ELEMENTS, lambda e: f'NOT ({self._wrong(x, at.inside(e))})')}")]

    def _format(self, keyword, x, schema, at):
        return [at.fault(keyword, f"{at.isa('string')} AND {at.fill(FORMATS[x])}")] if self.formats and x in FORMATS else []


def refused(values: DataFrame, column: str, contracts: Contracts, name: str) -> DataFrame:
    """The rows of ``values`` whose JSON text breaks a contract, with why: places and keywords such as /envelope/event_id: pattern, or not_json."""
    return contracts.plan(name).onto(values, column, "why", by_path=True).where(F.size("why") > 0)


def validate(spark: SparkSession, value: object, contracts: Contracts, name: str) -> None:
    """Refuses one value, given as Python objects, that breaks a contract."""
    if bad := refused(spark.createDataFrame([(json.dumps(value),)], "value string"), "value", contracts, name).collect():
        raise ContractError(f"{name}: {'; '.join(bad[0]['why'])}")
