"""Masking policies: documents that say which mask a group sees on a column."""

from __future__ import annotations

import json
from pathlib import Path
from typing import Protocol

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilframe.functions.masks import apply_mask
from veilframe.operators.classify import DEFAULT_MASK, Manifest

DATA_MASK = 1
ANALYSTS, STEWARDS = "analysts", "stewards"


class MissingPolicy(RuntimeError):
    """A sensitive column has no mask; nothing is written."""


class MaskProvider(Protocol):
    name: str

    def masks(self, database: str, table: str, group: str) -> dict[str, str]: ...


def column_policy(database: str, table: str, column: str, mask: str) -> dict:
    """Analysts see the column masked, stewards see it."""
    items = [{"groups": [group], "dataMaskInfo": {"dataMaskType": kind}} for group, kind in ((ANALYSTS, mask), (STEWARDS, "MASK_NONE"))]
    resources = {k: {"values": [v]} for k, v in (("database", database), ("table", table), ("column", column))}
    return {"name": f"{database}.{table}.{column}", "isEnabled": True, "policyType": DATA_MASK, "resources": resources, "dataMaskPolicyItems": items}


def resolve(policies: list[dict], database: str, table: str, group: str) -> dict[str, str]:
    """{column: mask} for a group: enabled mask policies of the table, an own expression before the type, later ones win."""
    out: dict[str, str] = {}
    for p in policies:
        where = p.get("resources", {})
        applies = p.get("isEnabled", True) and p.get("policyType") == DATA_MASK
        if not (applies and database in where["database"]["values"] and table in where["table"]["values"]):
            continue
        for item in p.get("dataMaskPolicyItems", []):
            if group in item.get("groups", []):
                info = item["dataMaskInfo"]
                out |= dict.fromkeys(where["column"]["values"], info.get("valueExpr") or info["dataMaskType"])
    return out


POLICY_SCHEMA = (
    "struct<name:string,isEnabled:boolean,policyType:int,resources:struct<database:struct<values:array<string>>,table:struct<values:array<string>>,column:struct<values:array<string>>>,"
    "dataMaskPolicyItems:array<struct<groups:array<string>,dataMaskInfo:struct<dataMaskType:string,valueExpr:string>>>>"
)


def resolve_frame(policies: DataFrame, database: str, table: str, group: str) -> DataFrame:
    """column, mask of policy documents in a column ``doc`` of JSON, numbered by ``position``; for policy stores too large for the driver."""
    p = policies.select("position", F.from_json("doc", POLICY_SCHEMA).alias("p"))
    rows = (
        p.where(F.coalesce("p.isEnabled", F.lit(True)) & (F.col("p.policyType") == DATA_MASK))
        .where(F.array_contains("p.resources.database.values", database) & F.array_contains("p.resources.table.values", table))
        .select("position", F.explode("p.resources.column.values").alias("column"), F.posexplode("p.dataMaskPolicyItems").alias("at", "item"))
        .where(F.array_contains("item.groups", group))
    )
    mask = F.coalesce(F.nullif("item.dataMaskInfo.valueExpr", F.lit("")), "item.dataMaskInfo.dataMaskType")
    return rows.groupBy("column").agg(F.max_by(mask, F.struct("position", "at")).alias("mask"))


class LocalPolicies:
    """Policies from files, in the order given."""

    name = "local-policy-files"

    def __init__(self, *paths: str | Path):
        self.policies = [p for path in paths if Path(path).exists() for p in json.loads(Path(path).read_text())["policies"]]

    def masks(self, database: str, table: str, group: str) -> dict[str, str]:
        return resolve(self.policies, database, table, group)


def choose_provider(*candidates: MaskProvider | None) -> MaskProvider:
    """The first that is there; its name is recorded with the data as masked_by."""
    found = next((c for c in candidates if c is not None), None)
    if found is None:
        raise MissingPolicy("no masking provider")
    return found


def generate(manifest: Manifest, database: str, path: str | Path, declared: dict[str, str] | None = None) -> list[str]:
    """Write policies for the sensitive columns that the file does not cover yet, and name them; what is there is never changed."""
    path = Path(path)
    policies = json.loads(path.read_text())["policies"] if path.exists() else []
    covered = resolve(policies, database, manifest.dataset, ANALYSTS)
    new = [c for c in manifest.columns if c.sensitive and c.name not in covered]
    policies += [column_policy(database, manifest.dataset, c.name, (declared or {}).get(c.name, DEFAULT_MASK[c.sensitivity])) for c in new]
    if new or not path.exists():
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(json.dumps({"policies": policies}, indent=2) + "\n")
    return [c.name for c in new]


def uncovered(sensitive: list[str], masks: dict[str, str]) -> list[str]:
    return sorted(set(sensitive) - set(masks))


def masked_view(df: DataFrame, masks: dict[str, str]) -> DataFrame:
    """The frame as a group sees it, for frames that hold plaintext."""
    return df.select(*(apply_mask(masks[c], F.col(c)).alias(c) if c in masks else F.col(c) for c in df.columns))


def missing_policies(columns: DataFrame, resolved: DataFrame) -> DataFrame:
    """The sensitive columns (name, sensitivity) that no resolved policy (column, mask) covers."""
    return columns.where(F.col("sensitivity") != "public").join(resolved.select(F.col("column").alias("name")), "name", "left_anti")
