"""Every query that has SQL, against DuckDB on the small tables."""

import math

import duckdb
import pytest

import __spark_entry__
from veilframe.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def plain(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else repr(round(v, 4) + 0.0)
        return repr(int(v)) if isinstance(v, int) else str(v)

    return sorted(columns), sorted(tuple(plain(r[i]) for i in order) for r in data)


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_equals_sql(spark, duck, name):
    got = __spark_entry__.queries()[name](spark, SF)
    want = duck.sql(catalog.ORACLES[name])
    assert rows(got.columns, [tuple(r) for r in got.collect()]) == rows(want.columns, want.fetchall())


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() == 10


def test_flagship_reads_only_what_it_needs(spark):
    plan = catalog.flagship(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "o_orderstatus" not in plan and "BroadcastHashJoin" in plan and "ArrowEvalPython" not in plan


def test_addresses_of_ids_beyond_16_bits(spark, tmp_path):
    ids = [3, 65532, 65536, 65540, 70000, 599_996, 2**32 + 4, 2**40 + 8]
    spark.createDataFrame([(i, i % 1500) for i in ids], "event_id long, user_id long").coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
    got = __spark_entry__.queries()["cidr_match"](spark, str(tmp_path))
    want = con.sql(catalog.ORACLES["cidr_match"])
    assert rows(got.columns, [tuple(r) for r in got.collect()]) == rows(want.columns, want.fetchall())


@pytest.mark.parametrize("name", ["published_messages", "validate_messages"])
def test_judging_takes_all_cores_though_the_table_is_one_file(spark, monkeypatch, name):
    from veilframe.operators import messages
    from veilframe.plans import catalog

    seen, judged = [], messages.judged
    monkeypatch.setattr(messages, "judged", lambda df, *more: seen.append(df.rdd.getNumPartitions()) or judged(df, *more))
    catalog.QUERIES[name](spark, "/root/testdata/sf0.001")
    assert seen and seen[0] >= spark.sparkContext.defaultParallelism
