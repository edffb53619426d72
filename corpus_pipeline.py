"""Corpus pipeline: quality, toxicity, near duplicates, packing.

Each stage takes (spark, docs, sf_dir); its result is written as Parquet and read
back as the next stage's docs. All but the last return the columns of ``docs``, in
any number and under any names, for the rows that they keep. Decisions are by row: a
stage numbers the rows of its input, so of rows that share a doc_id, or have none, each
stays or goes on its own. An empty table goes through all stages.

What a stage has written on the way is removed when the next one begins, or the same one
again, so its result must be written by then.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veilframe.llm import curve_packing, ngram_join, quality_resampling, toxicity_channel
from veilframe.llm.common import discard, recorded, saved, table
from veilframe.llm.queries import tokenizer_file


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
_left: list[DataFrame] = []  # what the latest stage wrote for itself


def _tidy(stage: Stage) -> Stage:
    """The stage, which first removes what the one before has left."""
    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        done, _left[:] = [x for x in _left if x.sparkSession is spark], []
        discard(*done)
        with recorded() as files:
            out = stage(spark, docs, sf_dir)
        _left.extend(files)
        return out

    return run


def _numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs``, written with a number for each row, and the name of that column."""
    name = "row"
    while name.lower() in (c.lower() for c in docs.columns):
        name += "_"
    return saved(docs.withColumn(name, F.monotonically_increasing_id())), name


def _kept(numbered: DataFrame, row: str, verdicts: DataFrame, keep: str) -> DataFrame:
    """The rows for which the verdicts say ``keep``, without their number."""
    return numbered.join(verdicts.where(keep).select(row), row, "left_semi").drop(row)


@_tidy
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that importance resampling draws.

    A null or empty text is as likely target as raw. Repeated rows, and rows of a null
    doc_id, have equal keys where doc_id and text are equal, and are drawn or left together.
    """
    numbered, row = _numbered(docs)
    return _kept(numbered, row, quality_resampling.judge(numbered, table(spark, sf_dir, "labels"), carry=(row,)), "kept")


@_tidy
def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that are not predicted toxic. A null or empty text scores the model's constant, which is low; repeated rows stay or go alike."""
    numbered, row = _numbered(docs)
    return _kept(numbered, row, toxicity_channel.score_toxicity(numbered, table(spark, sf_dir, "labels"), carry=(row,)), "predicted = 0")


@_tidy
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near duplicates: one of the smallest doc_id.

    Of repeated rows one stays; null and wordless texts are classes of their own; rows
    of a null doc_id are judged like others, and stay only where no named row is like them.
    """
    numbered, row = _numbered(docs)
    return _kept(numbered, row, ngram_join.near_duplicates(numbered, carry=(row,)), "kept")


@_tidy
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the kept documents, packed along the curve. A null or empty text is its end id; repeated rows are packed each."""
    return curve_packing.pack(docs, tokenizer_file("word_bpe_49k.json"))


STAGES = [("quality", quality), ("toxicity", toxicity), ("near_duplicates", near_duplicates), ("packing", packing)]

#: Models, min-hash signatures and tokens are beyond SQL; tests/llm hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        before, docs = docs, saved(stage(spark, docs, sf_dir))
        if hasattr(before, "saved_at"):
            discard(before)
    return STAGES[-1][1](spark, docs, sf_dir)
