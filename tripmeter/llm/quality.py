"""Quality rules whose limits come from the data: quantile sketches per language and source.

A sketch counts values in buckets whose width is a fixed share of the value, so two sketches are
merged by adding their counts; ``groupBy(group, metric, bucket).count()`` is the merge, combined
before the shuffle, and a hot source is as many small counters as any other.  Quantiles read from
the counters are within the relative error of the bucket width.  The limits of each language and
source are joined back to the documents.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmeter.llm.texts import id_and_text, map_texts
from tripmeter.llm.words import Words, covered, mix, windows

SYMBOLS = b"#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30
#: Buckets grow by this factor, so quantiles are at most 2 % above the exact ones.
GROWTH = 1.02
#: Metrics, and the limit of each where three quarters of the values are 0: such values tell what is usual, not how much is too much.
RARE = {"symbol_share": 0.1, "dup_line_share": 0.5, "word_length": 7.0, "repeat_share": 0.3}
#: A limit lies so many times the upper spread (third quartile less median, at least a bucket) above the third quartile.
SPREADS = 8.0
#: Documents from which on a language and source has limits of its own; below it takes those of the language, then of all.
LEAST_GROUP = 100

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True


def base_counts(docs: DataFrame, *keep: str) -> DataFrame:
    """``n_words, word_chars, n_symbols, n_dup_lines, n_lines, n_repeat_words`` of every text.

    Lines count if they have a word.  A null text counts as empty and has zeros; rows that repeat
    give a row each; of other columns only ``keep`` are read.
    """

    def compute(texts: list[bytes | None]) -> list:
        words = Words(texts)
        data, offsets = words.data, words.offsets
        inside = np.zeros(len(data) + 1, np.int8)
        inside[words.starts] += 1
        inside[words.ends] -= 1
        letters = (np.cumsum(inside[:-1], dtype=np.int8) > 0) & ((data & 0xC0) != 0x80)

        def per_text(flags: np.ndarray, places: np.ndarray) -> np.ndarray:
            sums = np.zeros(len(flags) + 1, np.int64)
            np.cumsum(flags, out=sums[1:])
            return np.diff(sums[places])

        lines = [[x for x in (t or b"").split(b"\n") if x.strip()] for t in texts]
        owner, n = words.owner(), len(words)
        grams = windows(words.hashes(), WINDOW)
        whole = np.flatnonzero(owner[: len(grams)] == owner[WINDOW - 1:]) if len(grams) else np.zeros(0, np.int64)
        keys = grams[whole] ^ mix(owner[whole].astype(np.uint64) + np.uint64(1))
        ordered = np.sort(keys)
        twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
        found = np.zeros(n, bool)
        if len(twice):
            at = np.minimum(np.searchsorted(twice, keys), len(twice) - 1)
            found = covered(whole[twice[at] == keys], WINDOW, n)
        return [
            words.counts,
            per_text(letters, offsets),
            per_text(_SYMBOL[data], offsets),
            [len(x) - len(set(x)) for x in lines],
            [len(x) for x in lines],
            per_text(found, words.first),
        ]

    return map_texts(
        id_and_text(docs, *keep),
        compute,
        "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_lines bigint, n_repeat_words bigint",
        keep=("doc_id", *keep),
    )


def bucket(value: Column) -> Column:
    """Bucket of a value of at least 0; bucket b > -1000 ends at GROWTH ** b, -1000 holds zero."""
    return F.when(value <= 1e-9, -1000).otherwise(F.ceil(F.log(value) / math.log(GROWTH))).cast("int")


def bucket_end(number: Column) -> Column:
    return F.when(number == -1000, 0.0).otherwise(F.pow(F.lit(GROWTH), number))


def sketch(values: DataFrame, group: list[str], metrics: list[str]) -> DataFrame:
    """``group, metric, bucket, n``: mergeable by adding ``n``."""
    long = values.select(*group, F.posexplode(F.array(*[bucket(F.col(m)) for m in metrics])).alias("metric", "bucket"))
    return long.groupBy(*group, "metric", "bucket").agg(F.count("*").alias("n"))


def quantiles(sketched: DataFrame, group: list[str], shares: list[float]) -> DataFrame:
    """``group, metric, q0, q1, ..., n``: the value below which each share of the group lies, and its size.

    A group has at most a few hundred buckets a metric, whatever its size.
    """
    order = Window.partitionBy(*group, "metric").orderBy("bucket")
    ranked = sketched.withColumn("up_to", F.sum("n").over(order)).withColumn("total", F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    return ranked.groupBy(*group, "metric").agg(
        *[bucket_end(F.min(F.when(F.col("up_to") >= F.lit(s) * F.col("total"), F.col("bucket")))).alias(f"q{i}") for i, s in enumerate(shares)],
        F.max("total").alias("n"),
    )


def fences(sketched: DataFrame, group: list[str], metrics: list[str]) -> DataFrame:
    """One row a group: for each metric a struct ``f_<metric>`` of its size and the limit its values set (NULL where most are 0)."""
    merged = sketched.groupBy(*group, "metric", "bucket").agg(F.sum("n").alias("n"))
    found = quantiles(merged, group, [0.5, 0.75])
    spread = F.greatest(F.col("q1") - F.col("q0"), F.col("q1") * (GROWTH - 1))
    fence = F.struct("n", F.when(F.col("q1") > 0, F.col("q1") + SPREADS * spread).alias("most"))
    return found.groupBy(*group).agg(*[F.max(F.when(F.col("metric") == i, fence)).alias(f"f_{m}") for i, m in enumerate(metrics)])


def limits(sketched: DataFrame, rare: dict[str, float] = RARE, least: int = LEAST_GROUP) -> DataFrame:
    """``lang, source`` and ``limit_<metric>`` for each metric, from the sketch of each language and source.

    A group of fewer than ``least`` documents takes the limits of its language, a language of fewer
    those of all: their sketches are sums of the groups' sketches.
    """
    own, wider = fences(sketched, ["lang", "source"], list(rare)), fences(sketched, ["lang"], list(rare))
    whole = fences(sketched, [], list(rare)).select(F.struct("*").alias("w")).scalar()
    joined = own.alias("o").join(wider.alias("l"), F.col("o.lang").eqNullSafe(F.col("l.lang"))).withColumn("_w", whole)

    def limit(m: str) -> Column:
        chosen = F.when(F.col(f"o.f_{m}.n") >= least, F.col(f"o.f_{m}.most")).when(F.col(f"l.f_{m}.n") >= least, F.col(f"l.f_{m}.most"))
        return F.coalesce(chosen.otherwise(F.col(f"_w.f_{m}.most")), F.lit(rare[m])).alias(f"limit_{m}")

    return joined.select("o.lang", "o.source", *[limit(m) for m in rare])


def quality(docs: DataFrame, scratch: str) -> DataFrame:
    """Base counts of every document, its metrics, the limits of its language and source, and the verdict.

    ``base_failed``: under 20 words, or over 30 % of the words in repeated 8-word windows.  ``kept``:
    not failed, and no metric above the limit of its language and source.  Limits are learned from
    the documents that did not fail; null languages and sources are groups of their own.  Texts of any
    length are read whole; rows that repeat count as often.  Counts and sketches are written to ``scratch``, a folder that all executors share, so texts are read once.
    """
    counted = base_counts(docs.withColumns({"lang": F.col("lang").cast("string"), "source": F.col("source").cast("string")}), "lang", "source")
    share = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))
    counted.write.parquet(f"{scratch}/counts")
    counted = docs.sparkSession.read.parquet(f"{scratch}/counts").withColumns({
        "base_failed": failed,
        "symbol_share": share("n_symbols", "word_chars"),
        "dup_line_share": share("n_dup_lines", "n_lines"),
        "word_length": share("word_chars", "n_words"),
        "repeat_share": share("n_repeat_words", "n_words"),
    })
    sketch(counted.where(~F.col("base_failed")), ["lang", "source"], list(RARE)).write.parquet(f"{scratch}/sketch")
    found = limits(docs.sparkSession.read.parquet(f"{scratch}/sketch"))
    joined = counted.alias("c").join(
        found.alias("l"), F.col("c.lang").eqNullSafe(F.col("l.lang")) & F.col("c.source").eqNullSafe(F.col("l.source")), "left"
    )
    fine = F.lit(True)
    for m in RARE:
        fine &= F.col(m) <= F.coalesce(F.col(f"limit_{m}"), F.lit(RARE[m]))
    return joined.select("c.*", *[F.col(f"l.limit_{m}") for m in RARE], (~F.col("base_failed") & fine).alias("kept"))
