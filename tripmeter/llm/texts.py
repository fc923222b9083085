"""Feeding whole texts to vectorised functions, one bounded piece of a partition at a time."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Bytes of text that one call handles at once; a longer text is a piece of its own.
PIECE_BYTES = 1 << 20

#: Rows that are sent to a worker at once.
BATCH_ROWS = 2000

#: Words as Spark's regular expressions see them.
WORD = "[^\\x20\\x09-\\x0D]+"

#: Lower-cases A-Z and turns what is no word character into a space; for words of [^\x00-\x2F\x3A-\x60\x7B-\x7F]+.
PLAIN = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
#: Lower-cases A-Z only.
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def reach_workers(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package from where the driver has it, and send them small batches.

    The first does nothing where it is installed; where executors do not see the folder, ship it with
    ``--py-files`` as usual.  Texts are long, so a batch of the default 10,000 rows is tens of
    megabytes in the executor and again in the worker.
    """
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(rows)) <= BATCH_ROWS:
        spark.conf.set(rows, str(BATCH_ROWS))
    root, sent = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    known = [p for p in sent.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in known:
        sent["PYTHONPATH"] = os.pathsep.join([*known, root])
    return spark


def documents(spark: SparkSession, folder: str) -> DataFrame:
    """The table of documents."""
    return reach_workers(spark).read.parquet(f"{folder}/documents.parquet")


def id_and_text(docs: DataFrame, *more: str) -> DataFrame:
    """The columns that an operator reads, whatever else the table has."""
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), *[m for m in more if not (isinstance(m, str) and m == "text")])


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """Names for further columns that no column of ``df`` has."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def text_hash() -> Column:
    """Tells apart rows that share an id."""
    return F.xxhash64(F.col("text").cast("string"))


def pieces(texts: pa.Array, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``limit`` bytes each."""
    sizes = np.asarray(pa.compute.fill_null(pa.compute.binary_length(texts), 0), dtype=np.int64)
    begin = total = 0
    for i, size in enumerate(sizes.tolist()):
        total += size + 64
        if total >= limit:
            yield begin, i + 1
            begin, total = i + 1, 0
    if begin < len(sizes):
        yield begin, len(sizes)


def as_bytes(texts: pa.Array) -> list[bytes | None]:
    return texts.cast(pa.large_binary()).to_pylist()


def map_texts(
    docs: DataFrame,
    compute: Callable[[list[bytes | None]], list],
    schema: str,
    keep: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """``keep`` and what ``compute`` makes of every text.

    ``compute`` gets the texts of one piece as UTF-8 (None where null) and returns one list or
    array per further column of ``schema``.  The result has a row for each row of ``docs``.
    """
    read = keep if "text" in keep else (*keep, "text")
    frame = docs.select(*read)
    at = read.index("text")
    reach_workers(docs.sparkSession)
    out = StructType([*(frame.schema[c] for c in keep), *StructType.fromDDL(schema)])
    n = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(out)
        for batch in batches:
            texts = batch.column(at)
            for begin, end in pieces(texts):
                part = batch.slice(begin, end - begin)
                made = compute(as_bytes(part.column(at)))
                columns = [part.column(i).cast(arrow.field(i).type) for i in range(n)]
                columns += [pa.array(c, type=arrow.field(n + i).type, from_pandas=False) for i, c in enumerate(made)]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return frame.mapInArrow(run, out)
