"""Messages: envelope, payloads, validation, decoding, and what a consumer does with a repeat."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilframe.functions.ids import SCHEMA_VERSION, event_id, idempotency_key, iso_z
from veilframe.operators import json_contracts
from veilframe.operators.protect import CIPHER, INDEX, LeakError, flat_leaks

ENCRYPTED, FLAT, VERDICT = "row.encrypted", "row.flat", "run.verdict"
TOPICS = {ENCRYPTED: "rows.encrypted", FLAT: "rows.flat", VERDICT: "control"}
#: The contract of each event type, and of messages of any other; files of CONTRACTS.
SCHEMA_OF, ANY_SCHEMA = {ENCRYPTED: "row_encrypted.schema.json", FLAT: "row_flat.schema.json", VERDICT: "run_verdict.schema.json"}, "envelope.schema.json"
STAGE_SCHEMA = "stage_event.schema.json"
CONTRACTS = json_contracts.Contracts.read(Path(__file__).parents[1] / "schemas")
ENVELOPE_FIELDS = "schema_version event_type event_id idempotency_key dataset logical_date run_slot trace_id run_id try_number key producer produced_at".split()
ENVELOPE_TYPE = "struct<" + ",".join(f"{f}:{'int' if f == 'try_number' else 'string'}" for f in ENVELOPE_FIELDS) + ">"
MESSAGE_TYPE = f"struct<envelope:{ENVELOPE_TYPE},payload:map<string,string>,signature:string>"


def envelope(event_type: str, dataset: str, run_slot: Column, trace_id: Column, run_id: str, try_number: int, key: Column, producer: str, produced_at: Column) -> Column:
    """The struct around every payload; ``run_slot`` and ``produced_at`` are timestamps."""
    slot = iso_z(run_slot)
    idem = idempotency_key(event_type, dataset, slot, key)
    values = {
        "schema_version": F.lit(SCHEMA_VERSION), "event_type": F.lit(event_type), "event_id": event_id(idem, run_id, try_number), "idempotency_key": idem,
        "dataset": F.lit(dataset), "logical_date": F.date_format(run_slot, "yyyy-MM-dd"), "run_slot": slot, "trace_id": trace_id, "run_id": F.lit(run_id),
        "try_number": F.lit(try_number), "key": key.cast("string"), "producer": F.lit(producer), "produced_at": iso_z(produced_at),
    }
    return F.struct(*(v.alias(k) for k, v in values.items()))


def payload(df: DataFrame, columns: list[str]) -> Column:
    """The columns as a map of text, in order of name; times in ISO form."""
    kinds = dict(df.dtypes)
    text = {c: iso_z(F.col(c)) if kinds[c].startswith("timestamp") else F.col(c).cast("string") for c in sorted(columns)}
    return F.map_from_arrays(F.array(*map(F.lit, text)), F.array(*text.values()))


def row_messages(df: DataFrame, make_envelope, columns: list[str], sensitive: list[str]) -> DataFrame:
    """topic, key, value (JSON) of two messages a row: what is encrypted, and what is public.

    ``make_envelope(event_type)`` gives the envelope. Refuses public columns that hold or derive from sensitive values.
    """
    sealed = [c for c in columns if c.endswith((CIPHER, INDEX))]
    public = [c for c in columns if c not in sealed]
    if leaks := flat_leaks(public, sensitive):
        raise LeakError(f"public message would hold {', '.join(leaks)}")
    parts = [(kind, make_envelope(kind), payload(df, own)) for kind, own in ((ENCRYPTED, sealed), (FLAT, public))]
    both = F.array(*(F.struct(F.lit(TOPICS[kind]).alias("topic"), e.alias("envelope"), p.alias("payload")) for kind, e, p in parts))
    out = df.select(F.explode(both).alias("m"))
    value = F.to_json(F.struct("m.envelope", "m.payload"), {"ignoreNullFields": "false"})
    return out.select("m.topic", F.coalesce("m.envelope.key", "m.envelope.idempotency_key").alias("key"), value.alias("value"))


def canonical_json(obj: object) -> str:
    """Sorted keys, no white space, characters as they are: what is signed."""
    return json.dumps(obj, sort_keys=True, separators=(",", ":"), ensure_ascii=False, default=str)


def _rules(contracts: json_contracts.Contracts) -> json_contracts.Plan:
    return contracts.selected(("envelope", "event_type"), SCHEMA_OF, ANY_SCHEMA)


def judged(messages: DataFrame, raw: str = "value", name: str = "problems", contracts: json_contracts.Contracts = CONTRACTS) -> DataFrame:
    """``messages`` with the sorted codes of what is wrong with each JSON text, by the contract that its event type selects.

    A text that is null or no JSON is not_json.
    """
    return _rules(contracts).onto(messages, raw, name)


def parse(raw: Column) -> Column:
    """The message of a JSON text, unjudged; null where it is not JSON or has no envelope and payload."""
    m = F.from_json(raw, MESSAGE_TYPE)
    return F.when(m["envelope"].isNotNull() & m["payload"].isNotNull(), m)


def decode(raw: Column, contracts: json_contracts.Contracts = CONTRACTS) -> Column:
    """The same with what is wrong with it; for a table rather :func:`judged` and :func:`parse`."""
    return F.when(parse(raw).isNotNull(), F.from_json(raw, MESSAGE_TYPE).withField("problems", _rules(contracts).column(raw)))


def problems(m: Column) -> Column:
    """Sorted codes of what is wrong with a decoded message; an empty array if nothing is."""
    return F.coalesce(m["problems"], F.array(F.lit("not_json")))


def dedupe(messages: DataFrame, consumer: str | None = None, order: tuple[str, ...] = ("offset",)) -> DataFrame:
    """Each message with its decision: drop (event seen), replay (unit seen under another event) or first.

    ``messages`` (event_id, idempotency_key, the columns of ``order``, which tell messages
    apart, and, unless one is named, consumer). A unit's history is in order of arrival. First
    arrivals come from aggregates, so a unit that is sent very often is not one task's.
    """
    who = ["consumer"] if consumer is None else []
    place = F.struct(*order)
    events = messages.groupBy(*who, "event_id").agg(F.min(F.struct(place.alias("at"), "idempotency_key")).alias("e"))
    units = events.groupBy(*who, F.col("e.idempotency_key").alias("idempotency_key")).agg(F.min("e.at").alias("unit_at"))

    def joined(left: DataFrame, right: DataFrame, keys: list[str], keep: str) -> DataFrame:
        right = right.select(*(F.col(k).alias(f"__{k}") for k in keys), F.col(keep).alias(f"__{keep}"))
        on = [left[k].eqNullSafe(right[f"__{k}"]) for k in keys]
        return left.join(right, on).drop(*(f"__{k}" for k in keys))

    seen = joined(messages, events.withColumn("event_at", F.col("e.at")), [*who, "event_id"], "event_at")
    seen = joined(seen, units, [*who, "idempotency_key"], "unit_at")
    return seen.withColumn("decision", F.when(place > F.col("__event_at"), "drop").when(place > F.col("__unit_at"), "replay").otherwise("first")).drop("__event_at", "__unit_at")


def latest_by_slot(verdicts: DataFrame, by: str = "dataset", order: tuple[str, ...] = ("run_slot", "offset")) -> DataFrame:
    """The verdict of each dataset's latest slot; of several for that slot the one that came last."""
    rest = [c for c in verdicts.columns if c != by]
    return verdicts.groupBy(by).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("r")).select(by, *(F.col("r")[c].alias(c) for c in rest))


def wakes(m: Column) -> Column:
    """Whether a decoded message starts the next pipeline: a verdict to proceed."""
    return F.coalesce((F.size(problems(m)) == 0) & (m["envelope"]["event_type"] == VERDICT) & (F.element_at(m["payload"], "proceed") == "true"), F.lit(False))


def incompatible(old: dict, new: dict, path: str = "") -> list[str]:
    """What a new message schema breaks for readers of the old one (JSON Schema as a dict)."""
    out = [f"{path}/{f}: no longer required" for f in old.get("required", []) if f not in new.get("required", [])]
    kinds = lambda s: set(s["type"] if isinstance(s.get("type"), list) else [s["type"]]) if "type" in s else None
    if kinds(old) and kinds(new) and not kinds(old) <= kinds(new):
        out.append(f"{path}: type {old['type']} became {new['type']}")
    if "enum" in old and set(old["enum"]) - set(new.get("enum", old["enum"])):
        out.append(f"{path}: enum values removed")
    if "const" in old and old["const"] != new.get("const", old["const"]):
        out.append(f"{path}: const changed")
    for name, own in old.get("properties", {}).items():
        later = new.get("properties", {}).get(name)
        out += [f"{path}/{name}: removed"] if later is None else incompatible(own, later, f"{path}/{name}")
    for k, (a, b) in enumerate(zip(old.get("allOf", []), new.get("allOf", []), strict=False)):
        out += incompatible(a, b, f"{path}/allOf/{k}")
    return out


def embeds_envelope(schema: dict, reference: str = "envelope.schema.json") -> bool:
    """Whether a payload schema takes the envelope over by reference and does not override it."""
    return any(x.get("$ref") == reference for x in schema.get("allOf", [])) and "envelope" not in schema.get("properties", {})


def rejoin(messages: DataFrame) -> DataFrame:
    """Each row's encrypted and public payload side by side again, by the key and slot of their envelopes."""
    sides = [
        messages.where(F.col("message.envelope.event_type") == kind).select(
            F.col("message.envelope.dataset").alias("dataset"), F.col("message.envelope.run_slot").alias("run_slot"), F.col("message.envelope.key").alias("key"), F.col("message.payload").alias(name),
        ) for kind, name in ((ENCRYPTED, "encrypted"), (FLAT, "flat"))
    ]
    return sides[0].join(sides[1], ["dataset", "run_slot", "key"])


def stage_details(events: DataFrame, details: dict[str, list[str]]) -> DataFrame:
    """run_id, stage, detail of stage events (run_id, stage, event as a map): only the keys that a verdict repeats."""
    wanted = F.lit(None).cast("array<string>")
    for stage, keys in details.items():
        wanted = F.when(F.col("stage") == stage, F.array(*map(F.lit, keys))).otherwise(wanted)
    return events.select("run_id", "stage", F.map_filter("event", lambda k, v: F.array_contains(wanted, k) & v.isNotNull()).alias("detail"))


def alerts(decisions: DataFrame, keep: int = 100) -> DataFrame:
    """The latest alerts of a decision log (client, ts, allowed, reason): refusals, newest first, a bounded report."""
    return decisions.where(~F.col("allowed")).select(F.concat(F.lit("traffic_"), F.replace("reason", F.lit(" "), F.lit("_"))).alias("kind"), "client", "ts").orderBy(F.desc("ts"), "client", "kind").limit(keep)
