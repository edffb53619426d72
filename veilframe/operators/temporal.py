"""Joins and groups by time: the latest row before each row, overlapping spans, sessions.

One key may hold a third of all rows, so no key is ordered in one task: rows are cut at
moments that part the whole table evenly, each (key, part) is ordered by itself, and what
reaches over a cut is carried on through one row for each key and part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def micros(at: Column) -> Column:
    return F.unix_micros(at.cast("timestamp"))


def _cuts(moments: DataFrame, parts: int | None) -> list[int]:
    """Moments (of column __at) that cut rows into even parts: as many as there are shuffle partitions, unless ``parts`` says otherwise."""
    n = parts or int(moments.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return sorted({int(x) for x in moments.approxQuantile("__at", [i / n for i in range(1, n)], 0.2 / n)}) if n > 1 else []


def _part(cuts: list[int]) -> Column:
    """Number of cuts at or before __at, by binary search in the plan."""
    def search(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(F.col("__at") < F.lit(cuts[mid]), search(lo, mid)).otherwise(search(mid + 1, hi))

    return search(0, len(cuts))


def as_of(left: DataFrame, right: DataFrame, keys: list[str], at: str, tie: tuple[str, ...], parts: int | None = None) -> DataFrame:
    """Every row of ``left`` with the other columns of the last row of ``right`` that has its keys and a time at or before its own; nulls if there is none.

    Of rows of ``right`` with equal keys and times the one counts whose columns ``tie`` are
    greatest. Rows of ``left`` with a null key or time find nothing; such rows of ``right``
    are found by none. Only distinct (keys, time) are ordered, so rows that share them, on
    either side, do not make a part large.
    """
    values = [c for c in right.columns if c not in (*keys, at)]
    if clash := {c.lower() for c in values} & {c.lower() for c in left.columns}:
        raise ValueError(f"both sides have columns {sorted(clash)}")
    some = F.lit(True)
    for k in keys:
        some &= F.col(k).isNotNull()
    own = F.struct(*(F.col(c) for c in (*tie, *(v for v in values if v not in tie))))
    found = right.withColumn("__at", micros(F.col(at))).where(some & F.col("__at").isNotNull()).groupBy(*keys, "__at").agg(F.max(own).alias("__v"))
    asked = left.withColumn("__at", micros(F.col(at))).where(some & F.col("__at").isNotNull()).select(*keys, "__at").distinct()
    both = found.withColumn("__asked", F.lit(False)).unionByName(asked.withColumn("__asked", F.lit(True)), allowMissingColumns=True)
    times = left.select(micros(F.col(at)).alias("__at")).unionByName(right.select(micros(F.col(at)).alias("__at")))
    both = both.withColumn("__part", _part(_cuts(times.where("__at is not null"), parts)))
    local = F.last("__v", ignorenulls=True).over(W.partitionBy(*keys, "__part").orderBy("__at", "__asked"))
    tails = both.where(~F.col("__asked")).groupBy(*keys, "__part").agg(F.max_by("__v", "__at").alias("__tail"))
    here = both.where("__asked").select(*keys, "__part").distinct()
    ends = here.join(tails, [*keys, "__part"], "full")  # one row for each key and part
    carried = ends.withColumn("__carried", F.last("__tail", ignorenulls=True).over(W.partitionBy(*keys).orderBy("__part").rowsBetween(W.unboundedPreceding, -1))).select(*keys, "__part", "__carried")
    answers = both.withColumn("__local", local).where("__asked").join(carried, [*keys, "__part"], "left")
    answers = answers.select(*(F.col(k).alias(f"__{k}") for k in keys), F.col("__at").alias("__moment"), F.coalesce("__local", "__carried").alias("__v"))
    on = micros(left[at]) == answers["__moment"]
    for k in keys:
        on &= left[k] == answers[f"__{k}"]
    return left.join(answers, on, "left").select(*(left[c] for c in left.columns), *(F.col("__v")[c].alias(c) for c in values))


def overlaps(left: DataFrame, right: DataFrame, left_span: tuple[str, str | None], right_span: tuple[str, str | None], keys: tuple[str, ...] = ()) -> DataFrame:
    """All pairs of rows with equal keys whose spans [start, end) overlap, each once; a span without an end is the one moment of its start.

    A span's level is the least power of two (of microseconds) that it fits in, so it lies in
    two bins of its level at most. A pair meets at the greater of its two levels, in the first
    bin that both are in. So a span is repeated by the number of levels in use at most, of
    which there are few, however long it is, and the join is one on equality. Empty, reversed
    and null spans, and null keys, overlap nothing. Columns other than the keys must differ by name.
    """
    if clash := ({c.lower() for c in left.columns} & {c.lower() for c in right.columns}) - {k.lower() for k in keys}:
        raise ValueError(f"both sides have columns {sorted(clash)}")

    def spans(df: DataFrame, span: tuple[str, str | None], side: str) -> DataFrame:
        start = micros(F.col(span[0]))
        end = micros(F.col(span[1])) if span[1] else start + 1
        out = df.withColumns({f"__{side}0": start, f"__{side}1": end}).where(f"__{side}0 < __{side}1")
        return out.withColumn(f"__{side}level", F.length(F.bin(F.col(f"__{side}1") - F.col(f"__{side}0") - 1)))

    sides = {"l": spans(left, left_span, "l"), "r": spans(right, right_span, "r")}
    used = {s: [r[0] for r in df.select(f"__{s}level").distinct().collect()] for s, df in sides.items()}  # 64 numbers at most

    def binned(side: str, other: str) -> DataFrame:
        level = F.col(f"__{side}level")
        meets = F.filter(F.array_distinct(F.concat(F.array(level), F.array(*map(F.lit, used[other])).cast("array<int>"))), lambda x: x >= level)
        at = sides[side].withColumn("__level", F.explode(meets))
        return at.withColumn("__bin", F.explode(F.sequence(F.expr(f"shiftright(__{side}0, __level)"), F.expr(f"shiftright(__{side}1 - 1, __level)"))))

    pairs = binned("l", "r").join(binned("r", "l"), [*keys, "__level", "__bin"])
    pairs = pairs.where("__l0 < __r1 AND __r0 < __l1 AND __level = greatest(__llevel, __rlevel) AND __bin = shiftright(greatest(__l0, __r0), __level)")
    return pairs.select(*keys, *(c for c in left.columns if c not in keys), *(c for c in right.columns if c not in keys))


def sessions(events: DataFrame, key: str, at: str, gap_seconds: int, parts: int | None = None) -> DataFrame:
    """key, start, end, n of every run of events of a key in which none comes more than the gap after the one before; end is the last event.

    Rows with a null time are in no session; a null key is a key. Runs are found within
    (key, part); only the first and last of each can go on beyond a cut, and are joined by key,
    of which a key has two for each part at most.
    """
    gap = gap_seconds * 1_000_000
    rows = events.select(F.col(key).alias("key"), micros(F.col(at)).alias("__at")).where("__at is not null")
    rows = rows.withColumn("__part", _part(_cuts(rows, parts)))
    own = W.partitionBy("key", "__part").orderBy("__at")
    begins = F.coalesce(F.col("__at") - F.lag("__at").over(own) > gap, F.lit(True))
    runs = rows.withColumn("__run", F.sum(begins.cast("int")).over(own.rowsBetween(W.unboundedPreceding, 0)))
    runs = runs.groupBy("key", "__part", "__run").agg(F.min("__at").alias("a"), F.max("__at").alias("b"), F.count("*").alias("n"))
    runs = runs.withColumn("__edge", (F.col("__run") == 1) | (F.col("__run") == F.max("__run").over(W.partitionBy("key", "__part"))))
    along = W.partitionBy("key").orderBy("a")
    edges = runs.where("__edge").withColumn("__new", F.coalesce(F.col("a") - F.lag("b").over(along) > gap, F.lit(True)))
    edges = edges.withColumn("__group", F.sum(F.col("__new").cast("int")).over(along.rowsBetween(W.unboundedPreceding, 0)))
    joined = edges.groupBy("key", "__group").agg(F.min("a").alias("a"), F.max("b").alias("b"), F.sum("n").alias("n")).drop("__group")
    out = joined.unionByName(runs.where(~F.col("__edge")).select("key", "a", "b", "n"))
    return out.select(F.col("key").alias(key), F.timestamp_micros("a").alias("start"), F.timestamp_micros("b").alias("end"), "n")
