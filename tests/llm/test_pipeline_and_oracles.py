import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from tests.test_queries import TABLES, rows
from veilframe.llm import queries, toxicity_channel

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got, want = queries.QUERIES[name](spark, SF), con.sql(queries.ORACLES[name])
    assert rows(got.columns, [tuple(r) for r in got.collect()]) == rows(want.columns, want.fetchall())


def test_all_operators_are_registered():
    names = [n for n in __spark_entry__.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in __spark_entry__.queries()


def test_stages_one_by_one(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, ids, labels = docs.columns, set(docs.toPandas().doc_id), spark.read.parquet(f"{SF}/labels.parquet").toPandas()
    from veilframe.llm.common import saved

    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, saved(stage(spark, docs, SF))
        kept = set(docs.toPandas().doc_id)
        assert docs.columns == columns and kept < ids, name
        ids = kept
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF).toPandas()
    assert set(packed.doc_id) == ids
    junk = set(labels[labels.quality == 0].doc_id)
    assert not ids & junk
    assert corpus_pipeline.run(spark, SF).count() == len(packed)


def test_one_of_each_group_stays(spark):
    rows_ = [(None, "a b c d e f g"), (None, "nameless words of one row alone"), (5, "repeated rows of one id and text"), (5, "repeated rows of one id and text"), (1, "a b c d e f g"), (2, "a b c d e f g"), (3, "other words that stand quite alone"), (4, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows_], "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(r.doc_id or 0 for r in corpus_pipeline.near_duplicates(spark, docs, SF).collect()) == [0, 1, 3, 4, 5]


def test_stages_decide_by_row(spark):
    """Rows that share an id, have none or repeat; columns whose names the operators use; empty tables."""
    larger = "/root/testdata/sf0.01"
    source = spark.read.parquet(f"{larger}/documents.parquet")
    labels = spark.read.parquet(f"{larger}/labels.parquet")
    known = source.join(labels, "doc_id").orderBy("doc_id")
    predicted = toxicity_channel.score_toxicity(source, labels).select("doc_id", "predicted")
    toxic = known.join(predicted, "doc_id").where("toxic = 1 and predicted = 1").orderBy("doc_id").first().text
    junk = known.where("quality = 0").first().text
    clean = known.where("quality = 1 and toxic = 0").first().text
    odd = [(70_001, toxic), (70_001, clean), (None, toxic), (None, clean), (70_002, junk), (70_002, clean), (70_003, clean), (70_003, clean), (70_004, None), (70_005, ""), (70_006, "word " * 50_000)]
    odd = spark.createDataFrame(odd, "doc_id long, text string").select("doc_id", "text", F.lit("en").alias("lang"), F.lit("s").alias("source"), F.lit(1).cast("long").alias("n_chars"))
    docs = source.unionByName(odd).select("*", F.lit(1.5).alias("row"), F.lit("x").alias("score"), F.lit("y").alias("signature"))

    def left(df, number, text):
        return df.where(F.col("doc_id").eqNullSafe(F.lit(number)) & F.col("text").eqNullSafe(F.lit(text))).count()

    mild = corpus_pipeline.toxicity(spark, docs, larger)
    assert mild.columns == docs.columns
    assert [left(mild, n, toxic) for n in (70_001, None)] == [0, 0] and [left(mild, n, clean) for n in (70_001, None, 70_002, 70_003)] == [1, 1, 1, 2]
    assert [left(mild, 70_004, None), left(mild, 70_005, "")] == [1, 1]
    good = corpus_pipeline.quality(spark, docs, larger)
    assert good.columns == docs.columns and left(good, 70_002, junk) == 0 and left(good, 70_002, clean) == 1
    docs = spark.read.parquet(f"{SF}/documents.parquet").unionByName(odd).select("*", F.lit(1.5).alias("row"), F.lit("x").alias("score"), F.lit("y").alias("signature"))
    single = corpus_pipeline.near_duplicates(spark, docs, larger)
    assert single.columns == docs.columns
    assert single.where(F.col("text") == clean).count() <= 1 and [left(single, 70_004, None), left(single, 70_005, "")] == [1, 1]
    packed = corpus_pipeline.packing(spark, docs, larger)
    assert packed.where("start = 0").count() == docs.count()
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), larger).count() == 0
