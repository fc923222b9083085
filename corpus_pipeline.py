"""A training corpus from raw documents in five stages.

``STAGES`` lists them; each function takes (spark, docs, sf_dir) and works on all that the stage
before it kept.  ``run`` writes what each stage returns to the shared folder and goes on from there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmeter.llm import contamination, language, mixing, simhash, suffix_dedup
from tripmeter.llm.texts import documents, text_hash
from tripmeter.session import scratch_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: The network splits its chance over all languages it knows; a text below this is in none of them.
LEAST_SCORE = 0.35


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts that are null, have no letter, or are in no known language; a missing ``lang`` is filled in."""
    net = language.train(docs, language.remainder(3) != 1)
    found = language.identify(docs, net, "text", "lang", "source", "n_chars")
    return found.where((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select(
        "doc_id", "text", F.coalesce("lang", "lang_pred").alias("lang"), "source", "n_chars"
    )


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates."""
    return simhash.one_of_each(docs, scratch_path(spark, "simhash")).select(*COLUMNS)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts strings of 100 bytes that start earlier out of the texts; a document may be left empty.

    A character of which a byte is cut goes as a whole.
    """
    found = suffix_dedup.deduplicated(docs, suffix_dedup.WINDOW, suffix_dedup.GRAM, "lang", "source", "n_chars", readable=True)
    whole = F.when(F.size("spans") > 0, F.length("kept")).otherwise(F.col("n_chars"))
    return found.select(
        "doc_id", F.col("kept").alias("text"), "lang", "source", whole.cast("long").alias("n_chars")
    )


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of which a twentieth or more stands in windows of benchmark items."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return contamination.without_contaminated(docs, items, scratch_path(spark, "contamination")).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes words from, with how many words it takes (repeats counted)."""
    scratch = scratch_path(spark, "mixing")
    sized = mixing.word_counts(docs, "lang", text_hash().alias("text_hash"))
    mixed = mixing.mix(sized, scratch, keep=("lang", "text_hash")).where("taken > 0")
    key = {"id_key": F.coalesce(F.col("doc_id").cast("long"), F.lit(0)), "text_hash": text_hash()}
    texts = docs.withColumns(key).groupBy("id_key", "text_hash").agg(F.first("text").alias("text"))
    return mixed.withColumn("id_key", F.coalesce("doc_id", F.lit(0))).join(texts, ["id_key", "text_hash"]).select(
        "doc_id", "text", "lang", "source", "size", "source_size", "target", "taken"
    )


STAGES = [
    ("language", identify_language),
    ("near duplicates", drop_near_duplicates),
    ("repeated strings", cut_repeats),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
]

#: SQL has neither the network nor XXH64.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name.replace(' ', '-')}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
