"""Queries of whole runs: two slots of customers, from a CSV source to the warehouse, the card table, the audit and the registered table."""

from __future__ import annotations

import uuid
from datetime import datetime
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veilframe.operators import warehouse
from veilframe.plans import run
from veilframe.plans.registry import query, table
from veilframe.plans.relational_queries import _folder
from veilframe.plans.scalar_queries import DEMO_KEYS, LAST4, TEST_CARDS

SLOTS = (datetime(2026, 1, 1, 4), datetime(2026, 1, 1, 8))
#: The second slot has every even customer again, a unit richer, and a new one for every tenth.
_ROWS = f"""c AS (SELECT c_custkey AS id, c_name AS name, 'c' || c_custkey || '@example.com' AS email, [{', '.join(f"'{x}'" for x in TEST_CARDS)}][CAST(c_custkey % {len(TEST_CARDS)} + 1 AS INT)] AS card,
c_mktsegment AS segment, c_acctbal AS balance FROM customer WHERE c_custkey IS NOT NULL),
first_slot AS (SELECT *, '2026-01-01T04:00:00Z' AS run_slot FROM c),
second_slot AS (SELECT * REPLACE (balance + 1 AS balance), '2026-01-01T08:00:00Z' AS run_slot FROM c WHERE id % 2 = 0 UNION ALL SELECT * REPLACE (id + 1000000000 AS id), '2026-01-01T08:00:00Z' FROM c WHERE id % 10 = 0),
loaded AS (SELECT * FROM first_slot WHERE id NOT IN (SELECT id FROM second_slot) UNION ALL SELECT * FROM second_slot)"""


def _sources(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    cards = F.array(*map(F.lit, TEST_CARDS))
    rows = table(spark, sf_dir, "customer").where("c_custkey is not null").select(
        F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_name"), F.concat(F.lit("c"), "c_custkey", F.lit("@example.com")).alias("customer_email"),
        F.get(cards, (F.col("c_custkey") % len(TEST_CARDS)).cast("int")).alias("card_info"), F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance"),
    )
    new = rows.where("customer_id % 10 = 0").withColumn("customer_id", F.col("customer_id") + 1_000_000_000)
    return rows, rows.where("customer_id % 2 = 0").withColumn("balance", F.col("balance") + 1).unionByName(new)


def _runs(spark: SparkSession, sf_dir: str, stages: list[str], slots: int = 2) -> list[run.RunEnv]:
    """The runs of the slots, each over a CSV of its rows; a run that fails raises."""
    out, dataset = _folder(spark), f"customers_{uuid.uuid4().hex[:8]}"
    place = urlparse(out)
    # settings and reports are small files of the driver's own; with a remote shared folder they go beside it by path
    config, envs = place.path, []
    for slot, rows in zip(SLOTS[:slots], _sources(spark, sf_dir), strict=False):
        csv = f"{out}/source/{slot:%H}"
        rows.write.csv(csv, header=True, quote='"', escape='"')
        env = run.RunEnv(spark, slot, out, dataset, csv, keys=DEMO_KEYS, config=config)
        _, failures, _ = run.run(env, stages, verdict=False)
        if failures:
            raise RuntimeError(f"{failures[0]['stage']}: {failures[0]['message']}")
        envs.append(env)
    return envs


@query(f"""WITH {_ROWS} SELECT id AS customer_id, sha256(name) AS customer_name_masked, sha256(email) AS customer_email_masked, sha256(card) AS card_info_masked, {LAST4.format(c='segment')} AS segment_masked, balance, run_slot FROM loaded""")
def run_warehouse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The warehouse after both slots: types from the manifest, masks from the generated policies, the later slot's rows in place of the earlier's."""
    env = _runs(spark, sf_dir, ["extract", "encrypt", "mask", "load"])[-1]
    loaded = warehouse.VersionedTable(spark, f"{env.out}/warehouse/{env.dataset}").read()
    return loaded.select("customer_id", "customer_name_masked", "customer_email_masked", "card_info_masked", "segment_masked", "balance", "run_slot")


@query(f"""WITH {_ROWS} SELECT 'card_info' AS source_column, CAST(id AS VARCHAR) AS row_key, left(card, 6) AS card_prefix, right(card, 4) AS card_suffix, true AS sealed FROM c""")
def run_card_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The card table that the first slot wrote: clear ends, and whether the middle is an envelope."""
    env = _runs(spark, sf_dir, ["extract", "card_split"], 1)[0]
    return env.read("card_info").select("source_column", "row_key", "card_prefix", "card_suffix", F.col("card_middle_encrypted").startswith("enc:v1:").alias("sealed"))


@query(f"""WITH {_ROWS}, a AS (SELECT '2026-01-01T04:00:00Z' AS run_slot, count(*) AS inserted, CAST(0 AS BIGINT) AS updated FROM first_slot UNION ALL
SELECT '2026-01-01T08:00:00Z', count(*) FILTER (WHERE id NOT IN (SELECT id FROM c)), count(*) FILTER (WHERE id IN (SELECT id FROM c)) FROM second_slot)
SELECT run_slot, inserted, updated, (SELECT count(*) FROM loaded l WHERE l.run_slot = a.run_slot) AS in_scope FROM a""")
def run_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each load said it inserted and updated, and the warehouse's rows in the scope of each slot."""
    env = _runs(spark, sf_dir, ["extract", "encrypt", "mask", "load"])[-1]
    audit = spark.read.parquet(f"{env.out}/warehouse/load_audit").select("run_slot", "inserted", "updated")
    loaded = warehouse.VersionedTable(spark, f"{env.out}/warehouse/{env.dataset}").read()
    scopes = [warehouse.Scope("run_slot", slot.strftime("%Y-%m-%dT%H:%M:%SZ")) for slot in SLOTS]
    counts = loaded.agg(F.array(*(F.struct(F.lit(s.value).alias("run_slot"), F.count_if(s.predicate()).alias("in_scope")) for s in scopes)).alias("c")).select(F.inline("c"))
    return audit.join(counts, "run_slot")


@query(f"""WITH {_ROWS}, b AS (SELECT * FROM first_slot UNION ALL SELECT * FROM second_slot)
SELECT replace(replace(run_slot[:16], '-', ''), ':', '') || 'Z' AS run_slot, {LAST4.format(c='segment')} AS segment_masked, count(*) AS n, count(DISTINCT sha256(name)) AS n_names FROM b GROUP BY ALL""")
def run_registered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The masked artifacts of both slots by SQL over the table that the runs registered; the table stays in the session's catalog."""
    env = _runs(spark, sf_dir, ["extract", "encrypt", "mask", "hive_register"])[-1]
    return spark.sql(f"SELECT run_slot, segment_masked, count(*) AS n, count(DISTINCT customer_name_masked) AS n_names FROM {env.dataset}_masked GROUP BY run_slot, segment_masked")
