"""Tables that change in one step: data folders that are only added, and numbered manifests that list the current ones.

    <path>/data/write=<id>/[<column>=<value>/]…   the files of one write
    <path>/manifests/<number>                     "<partition><tab><folder>" for every current folder

A write is complete in a folder of its own before a manifest names it.  The manifest is written beside
and renamed to the next number, which fails if that number exists: a reader sees the old table or the
new one, a write that dies leaves the old one, and of two writers that began at the same version the
second is refused.  Folders that no kept manifest names can be removed with :func:`expire`.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tripmeter.session import file_system


class Conflict(RuntimeError):
    """Another writer has changed the table since this one began."""


def _children(spark: SparkSession, path: str) -> list[str]:
    files, where = file_system(spark, path)
    if not files.exists(where):
        return []
    return sorted(s.getPath().getName() for s in files.listStatus(where))


def version(spark: SparkSession, path: str) -> int:
    """Number of the current manifest, 0 without one."""
    numbers = [int(n) for n in _children(spark, f"{path}/manifests") if n.isdigit()]
    return max(numbers, default=0)


def folders(spark: SparkSession, path: str, number: int) -> list[tuple[str, str]]:
    """(partition, folder below ``data``) of a version."""
    if not number:
        return []
    files, where = file_system(spark, f"{path}/manifests/{number:012d}")
    stream = files.open(where)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return [tuple(line.split("\t")) for line in text.splitlines()]


def commit(spark: SparkSession, path: str, base: int, entries: list[tuple[str, str]]) -> int:
    """Make ``entries`` the version after ``base``; :class:`Conflict` if there is one already."""
    files, whole = file_system(spark, f"{path}/manifests/{base + 1:012d}")
    _, draft = file_system(spark, f"{path}/manifests/.{uuid.uuid4().hex}")
    stream = files.create(draft, False)
    stream.write("".join(f"{partition}\t{folder}\n" for partition, folder in entries).encode())
    stream.close()
    jvm = spark.sparkContext._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(whole.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = getattr(jvm.org.apache.hadoop.fs.Options.Rename, "NONE")
    try:
        context.rename(files.makeQualified(draft), files.makeQualified(whole), options)
    except Py4JJavaError as error:
        files.delete(draft, False)
        if "FileAlreadyExists" not in str(error.java_exception):
            raise
        raise Conflict(f"{path} has a version {base + 1} already") from error
    return base + 1


def write_data(df: DataFrame, path: str, column: str | None = None) -> list[tuple[str, str]]:
    """Store ``df`` in a new folder, by the values of ``column``; returns its entries."""
    name = f"write={uuid.uuid4().hex}"
    target = f"{path}/data/{name}"
    if column is None:
        df.write.parquet(target)
        return [("", name)]
    df.write.partitionBy(column).parquet(target)
    found = [c for c in _children(df.sparkSession, target) if c.startswith(f"{column}=")]
    return [(c, f"{name}/{c}") for c in found]


def replace(df: DataFrame, path: str) -> int:
    """The table becomes ``df``, which may read from it."""
    base = version(df.sparkSession, path)
    return commit(df.sparkSession, path, base, write_data(df, path))


def append(df: DataFrame, path: str) -> int:
    base = version(df.sparkSession, path)
    return commit(df.sparkSession, path, base, folders(df.sparkSession, path, base) + write_data(df, path))


def replace_partitions(df: DataFrame, path: str, column: str, base: int | None = None) -> int:
    """Exactly the partitions that occur in ``df`` are replaced; ``base`` is the version that ``df`` was made from."""
    spark = df.sparkSession
    base = version(spark, path) if base is None else base
    new = write_data(df, path, column)
    replaced = {partition for partition, _ in new}
    kept = [e for e in folders(spark, path, base) if e[0] not in replaced]
    return commit(spark, path, base, sorted(kept + new))


def read(spark: SparkSession, path: str, schema: StructType | None = None, number: int | None = None) -> DataFrame:
    """The current version, or an earlier one that is still kept."""
    number = version(spark, path) if number is None else number
    entries = folders(spark, path, number)
    if not entries:
        return spark.createDataFrame([], schema or StructType())
    reader = spark.read.option("basePath", f"{path}/data")
    reader = reader.schema(schema) if schema else reader
    found = reader.parquet(*[f"{path}/data/{folder}" for _, folder in entries])
    return found.select(*schema.fieldNames()) if schema else found.drop("write")


def expire(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Remove manifests before the last ``keep`` and the writes that none of the kept ones names; no writer may be at work."""
    numbers = sorted(int(n) for n in _children(spark, f"{path}/manifests") if n.isdigit())
    named = {folder.split("/")[0] for n in numbers[-keep:] for _, folder in folders(spark, path, n)}
    gone = [f"{path}/manifests/{n:012d}" for n in numbers[:-keep]]
    gone += [f"{path}/data/{w}" for w in _children(spark, f"{path}/data") if w not in named]
    for target in gone:
        files, where = file_system(spark, target)
        files.delete(where, True)
    return gone
