"""Mixing sources to target weights.

Every document gets a hash-random key.  All rows are sorted by (source, key) into ranges, so a hot
source is spread over many of them; the words of each range are summed, the sums of a source's
ranges are added up, and each range adds its own running sum.  The place of a document in its
source's random order, in words, is then known everywhere, and the cut at a source's budget is a
comparison.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmeter.llm.texts import WORD


def running_sums(rows: DataFrame, group: list[str], order: list[Column], values: list[str], scratch: str) -> DataFrame:
    """``rows`` with ``before_<value>``: the sum over the rows that stand earlier in the row's group.

    Rows are sorted into ranges by group and ``order``; no group has to fit into one range.  The
    ranges are written to ``scratch``, a folder that all executors share, so that sums and rows
    agree even if a lost executor has its part computed again.
    """
    spark = rows.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows.repartitionByRange(ranges, *group, *order).withColumn("part", F.spark_partition_id()).write.parquet(scratch)
    stored = spark.read.parquet(scratch)
    earlier = Window.partitionBy(*group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = stored.groupBy(*group, "part").agg(*[F.sum(v).alias(f"sum_{v}") for v in values])
    offsets = sums.select(*group, "part", *[F.coalesce(F.sum(f"sum_{v}").over(earlier), F.lit(0)).alias(f"offset_{v}") for v in values])
    same = F.lit(True)
    for g in [*group, "part"]:
        same &= F.col(f"s.{g}").eqNullSafe(F.col(f"o.{g}"))
    here = Window.partitionBy(*[F.col(f"s.{g}") for g in [*group, "part"]]).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return stored.alias("s").join(offsets.alias("o"), same).select(
        *[F.col(f"s.{c}") for c in rows.columns],
        *[(F.col(f"o.offset_{v}") + F.coalesce(F.sum(F.col(f"s.{v}")).over(here), F.lit(0))).alias(f"before_{v}") for v in values],
    )


def targets(sources: DataFrame, weights: Sequence[int], share: float, most: int, scratch: str) -> DataFrame:
    """``source, source_size, target`` from ``source, source_size``.

    The i-th source in code point order (null last) has weight ``weights[i % len(weights)]``.
    ``share`` times all words are given out by weight; what a source gets beyond ``most`` times its
    size goes to the others by weight, until none is above.  That is: the target is the smaller of
    ``most * size`` and ``weight * level``, for the one level at which targets add up.
    """
    ranked = running_sums(
        sources.select("source", "source_size", F.lit(1).alias("one"), F.lit(0).alias("all")),
        ["all"], [F.col("source").asc_nulls_last()], ["one"], f"{scratch}/ranked",
    )
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.col("before_one") % len(weights) + 1).cast("int"))
    weighed = ranked.select("source", "source_size", weight.cast("long").alias("weight"), "all").withColumns({
        "cap": F.col("source_size") * most, "full_at": F.col("source_size") * most / F.col("weight"),
    })
    total = weighed.agg(F.sum("source_size").alias("words"), F.sum("weight").alias("weight")).first()
    if total["words"] is None:
        return sources.select("source", "source_size", F.lit(0.0).alias("target"))
    budget = share * total["words"]
    # In the order in which sources fill up: the first at which the budget is used up sets the level.
    filled = running_sums(weighed, ["all"], [F.col("full_at"), F.col("source").asc_nulls_last()], ["cap", "weight"], f"{scratch}/filled")
    left = total["weight"] - F.col("before_weight")
    enough = F.col("before_cap") + F.col("full_at") * left >= budget
    first = filled.where(enough).agg(F.min_by(F.struct("before_cap", "before_weight"), F.struct("full_at", "before_weight")).alias("at")).first()["at"]
    if first is None:
        return weighed.select("source", "source_size", F.col("cap").cast("double").alias("target"))
    level = (budget - first["before_cap"]) / (total["weight"] - first["before_weight"])
    return weighed.select("source", "source_size", F.least(F.col("cap").cast("double"), F.col("weight") * F.lit(level)).alias("target"))


def word_counts(docs: DataFrame, *keep: str) -> DataFrame:
    """``doc_id, source, size`` and ``keep``; a null text has size 0."""
    size = F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(WORD)), F.lit(0)).cast("long")
    return docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), size.alias("size"), *keep)


def mix(
    sized: DataFrame, scratch: str, weights: Sequence[int] = (3, 1, 2), share: float = 1.5, most: int = 2, keep: Sequence[str] = ()
) -> DataFrame:
    """``doc_id, source, size, source_size, target, *keep, taken`` of every row of ``doc_id, source, size, *keep``.

    ``taken`` counts the words the mix takes from a document, repeats included: whole passes over a
    source, then its documents in random order up to the exact budget, the last one in part.  The
    order is that of md5 of the id, ties by id and size, so reruns agree; equal rows are
    interchangeable.  A null source is a source; a null id is an id of its own; empty documents
    take 0 words; an empty table gives no rows.  ``scratch`` is a folder that all executors share.
    """
    spark = sized.sparkSession
    key = F.md5(F.concat(F.lit("mix:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    sized.select("doc_id", "source", "size", key.alias("key"), *keep).write.parquet(f"{scratch}/sized")
    stored = spark.read.parquet(f"{scratch}/sized")
    goals = targets(stored.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most, f"{scratch}/targets")
    placed = running_sums(stored, ["source"], [F.col("key"), F.col("doc_id"), F.col("size")], ["size"], f"{scratch}/placed")
    goal = F.floor("g.target").cast("long")
    passes = F.coalesce(F.try_divide(goal, F.col("g.source_size")).cast("long"), F.lit(0))
    rest = goal - passes * F.col("g.source_size") - F.col("p.before_size")
    return placed.alias("p").join(goals.alias("g"), F.col("p.source").eqNullSafe(F.col("g.source"))).select(
        "p.doc_id", "p.source", "p.size", "g.source_size", "g.target", *[f"p.{c}" for c in keep],
        (passes * F.col("p.size") + F.greatest(F.lit(0), F.least(F.col("p.size"), rest))).cast("long").alias("taken"),
    )
