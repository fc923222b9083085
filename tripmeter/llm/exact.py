"""Exact duplicates through an extendible-hash index on shared files.

Texts are equal when they are identical without white space.  Every task that reads documents sends
each text it meets once (an entry); later copies of its window name that entry.  Entries are spread
over buckets by the leading bits of their hash.  A directory says how many bits each bucket goes by:
it starts with buckets that are half full on average, and as long as some hold too much, it doubles
and those are split by one more bit.  Directory and buckets are files in the shared folder.

A task owns the key range of a bucket.  It chains the entries of equal hash and compares their bytes,
so nothing rests on the hash.  A bucket with a single hash cannot be split: its entries are dealt into
parts, each part is compared alone, and the entries that stay are indexed again, until every bucket
is one part.  So no bucket, part or window grows with the number of copies.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tripmeter.llm.texts import as_bytes, pieces, reach_workers
from tripmeter.operators.skew import join_facts

#: Text that a bucket holds before it is split.
BUCKET_BYTES = 8 << 20
#: Text that a reading task remembers, to send later copies by name.
WINDOW_BYTES = 16 << 20
#: What an entry takes besides its text.
ENTRY_BYTES = 64
#: Entries that a part of an unsplittable bucket has at least in the first round; twice as many in each later one,
#: so the rounds end even where different texts have one hash.
PART_ENTRIES = 4
WHITE = b"\x20\x09\x0a\x0b\x0c\x0d"

_ENTRY = "hash bigint, size bigint, content binary"
_LINK = "ref bigint, into bigint, place int, parts int, hash bigint, size bigint, content binary"


def stage_rows(docs: DataFrame, path: str, keep: tuple[str, ...] = (), hash_bits: int = 64) -> DataFrame:
    """All rows, stored: ``row, doc_id, n_chars, carried, sha256, ref`` and, for the first of its text in a window, an entry.

    ``row`` numbers the rows, ``ref`` is the row that sent the text, ``carried`` holds the columns ``keep``.
    """
    reach_workers(docs.sparkSession)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    extra = F.struct(F.lit(0).alias("none"), *[F.col(f"`{c}`") for c in keep])
    frame = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.length(text).cast("long").alias("n_chars"), extra.alias("carried"), text.alias("text")
    )
    carried = list(frame.schema)[:3]
    out = StructType([*carried, *StructType.fromDDL(f"row bigint, ref bigint, sha256 string, {_ENTRY}")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(out)
        row = TaskContext.get().partitionId() << 40
        window: dict[bytes, int] = {}
        remembered = 0
        for whole in batches:
            for begin, end in pieces(whole.column(3)):
                batch = whole.slice(begin, end - begin)
                made: list[list] = [[], [], [], [], [], []]
                for text in as_bytes(batch.column(3)):
                    content = (text or b"").translate(None, WHITE)
                    digest = hashlib.sha256(content)
                    hashed = int.from_bytes(digest.digest()[:8], "big") >> (64 - hash_bits) << (64 - hash_bits)
                    hashed -= (hashed >> 63) << 64
                    ref = window.get(content)
                    first = ref is None
                    if first:
                        ref = row
                        if remembered > WINDOW_BYTES:
                            window, remembered = {}, 0
                        window[content] = row
                        remembered += len(content) + ENTRY_BYTES
                    values = (row, ref, digest.hexdigest(), hashed, len(content) + ENTRY_BYTES, content if first else None)
                    for column, value in zip(made, values, strict=True):
                        column.append(value)
                    row += 1
                columns = [batch.column(i).cast(arrow.field(i).type) for i in range(3)]
                columns += [pa.array(c, arrow.field(3 + i).type) for i, c in enumerate(made)]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    frame.mapInArrow(run, out).write.parquet(path)
    return docs.sparkSession.read.parquet(path)


def prefix(depth: int | Column) -> Column:
    """The first ``depth`` (1 to 64) bits of ``hash``."""
    return F.expr(f"shiftrightunsigned(hash, {64 - depth})")


def build_directory(
    entries: DataFrame, path: str, bucket_bytes: int = BUCKET_BYTES, part_entries: int = PART_ENTRIES
) -> tuple[int, list[str], DataFrame]:
    """The directory of ``entries``, stored below ``path``: first depth, the buckets split at each depth, unsplittable ones.

    A bucket is named by its depth and that many bits.  The folders ``split-<depth>`` hold the bits of
    buckets that were split by one more; the last frame has ``depth, bits, parts`` of buckets of a single
    hash that still hold too much.
    """
    spark = entries.sparkSession
    keys = entries.select("hash", "size")
    total = keys.agg(F.sum("size")).first()[0] or 0
    first = depth = max(1, math.ceil(math.log2(max(1, 2 * total / bucket_bytes))))
    split, unsplittable = [], []
    while True:
        counted = keys.groupBy(prefix(depth).alias("bits")).agg(
            F.sum("size").alias("size"), F.count("*").alias("n"), (F.min("hash") == F.max("hash")).alias("single")
        ).where(F.col("size") > bucket_bytes)
        counted.write.parquet(f"{path}/full-{depth}")
        full = spark.read.parquet(f"{path}/full-{depth}")
        parts = F.least(F.ceil(F.col("size") / bucket_bytes), F.ceil(F.col("n") / part_entries)).cast("int")
        unsplittable.append(full.where(F.col("single")).select(F.lit(depth).alias("depth"), "bits", parts.alias("parts")))
        full.where(~F.col("single")).select("bits").write.parquet(f"{path}/split-{depth}")
        splitting = spark.read.parquet(f"{path}/split-{depth}")
        if splitting.isEmpty():
            break
        split.append(f"{path}/split-{depth}")
        # The directory doubles; only what was in a split bucket has to be counted by one more bit.
        keys = entries.select("hash", "size").join(splitting, prefix(depth) == F.col("bits"), "left_semi")
        depth += 1
    table = unsplittable[0]
    for more in unsplittable[1:]:
        table = table.unionByName(more)
    return first, split, table.where("parts > 1")


def routed(entries: DataFrame, directory: tuple[int, list[str], DataFrame]) -> DataFrame:
    """``entries`` with ``depth, bits, part, parts``: the bucket that the directory gives, and the part of it."""
    first, split, unsplittable = directory
    spark = entries.sparkSession
    found = entries.withColumn("depth", F.lit(first))
    for step, folder in enumerate(split):
        depth = first + step
        there = spark.read.parquet(folder).select(F.col("bits").alias("split_bits"))
        found = found.join(there, (F.col("depth") == depth) & (prefix(depth) == F.col("split_bits")), "left")
        found = found.withColumn("depth", F.col("depth") + F.col("split_bits").isNotNull().cast("int")).drop("split_bits")
    bits = F.expr("shiftrightunsigned(hash, 64 - depth)")
    large = unsplittable.select(F.col("depth").alias("at"), F.col("bits").alias("large_bits"), "parts")
    found = found.withColumn("bits", bits).join(large, (F.col("depth") == F.col("at")) & (F.col("bits") == F.col("large_bits")), "left")
    parts = F.coalesce("parts", F.lit(1))
    return found.select(
        "ref", *StructType.fromDDL(_ENTRY).names, "depth", "bits", F.pmod(F.xxhash64("ref"), parts).cast("int").alias("part"), parts.alias("parts")
    )


def own_bucket(table: pa.Table) -> pa.Table:
    """What the owner of a bucket finds: for each entry the first one with the same bytes, and its place in the chain of its hash.

    Where the bucket has other parts, entries that stay are returned with their bytes, for the next round.
    """
    table = table.sort_by("ref")
    refs, hashes, parts = (table.column(n).to_pylist() for n in ("ref", "hash", "parts"))
    chains: dict[int, list[tuple[bytes, int]]] = {}
    into, place = [], []
    for ref, hashed, content in zip(refs, hashes, table.column("content").to_pylist(), strict=True):
        chain = chains.setdefault(hashed, [])
        at = next((i for i, (other, _) in enumerate(chain) if other == content), len(chain))
        if at == len(chain):
            chain.append((content, ref))
        into.append(chain[at][1])
        place.append(at)
    again = pa.array([a != b or p == 1 for a, b, p in zip(refs, into, parts, strict=True)], pa.bool_())
    nothing = pa.nulls(len(refs), pa.binary())
    content = pa.compute.if_else(again, nothing, table.column("content").combine_chunks().cast(pa.binary()))
    return pa.table({
        "ref": table.column("ref"), "into": pa.array(into, pa.int64()), "place": pa.array(place, pa.int32()),
        "parts": table.column("parts").cast(pa.int32()), "hash": table.column("hash"), "size": table.column("size"), "content": content,
    })


def build_index(entries: DataFrame, path: str, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``ref, into``: for each entry (``ref, hash, size, content``) the entry that stands for its text.

    ``path`` gets a directory and the owners' chains for every round.
    """
    spark = entries.sparkSession
    found, number = None, 0
    while True:
        directory = build_directory(entries, f"{path}/directory-{number}", bucket_bytes, PART_ENTRIES << number)
        owned = routed(entries, directory).groupBy("depth", "bits", "part").applyInArrow(own_bucket, _LINK)
        owned.write.parquet(f"{path}/chains-{number}")
        chains = spark.read.parquet(f"{path}/chains-{number}")
        links = chains.select("ref", "into")
        if found is None:
            found = links
        else:
            later = links.select(F.col("ref").alias("into"), F.col("into").alias("last"))
            found = found.join(later, "into", "left").select("ref", F.coalesce("last", "into").alias("into"))
        entries = chains.where(F.col("content").isNotNull()).select("ref", *StructType.fromDDL(_ENTRY).names)
        if entries.isEmpty():
            return found
        number += 1


def exact_duplicates(
    docs: DataFrame, scratch: str, *keep: str, bucket_bytes: int = BUCKET_BYTES, hash_bits: int = 64
) -> DataFrame:
    """``row, doc_id, *keep, keep_id, group_size, kept, text_sha256`` of every row.

    Of equal texts (without white space) the row with the most code points stays, then the one with
    the smallest id; rows without an id come last, and of rows that repeat one stays.  A null text
    counts as empty.  Texts of any length are read whole.  An empty table gives no rows; other columns
    matter only if named in ``keep``.  ``scratch`` is a folder that all executors share; ``hash_bits``
    below 64 makes hashes collide (for tests).
    """
    spark = docs.sparkSession
    rows = stage_rows(docs, f"{scratch}/rows", keep, hash_bits)
    entries = rows.where(F.col("content").isNotNull()).select("ref", *StructType.fromDDL(_ENTRY).names)
    links = build_index(entries, f"{scratch}/index", bucket_bytes).where("ref != into")
    members = rows.select("row", "doc_id", "n_chars", "carried", "sha256", "ref")
    members.join(links, "ref", "left").select(
        "row", "doc_id", "n_chars", "carried", "sha256", F.coalesce("into", "ref").alias("text_ref")
    ).write.parquet(f"{scratch}/members")
    members = spark.read.parquet(f"{scratch}/members")
    first = F.min(F.struct(-F.col("n_chars"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "row"))
    members.groupBy("text_ref").agg(F.count("*").alias("group_size"), first.alias("first")).select(
        "text_ref", "group_size", F.col("first.doc_id").alias("keep_id"), F.col("first.row").alias("keep_row")
    ).write.parquet(f"{scratch}/groups")
    joined = join_facts(members, spark.read.parquet(f"{scratch}/groups"), ["text_ref"], "group_size")
    return joined.select(
        "row", "doc_id", *[F.col(f"carried.`{c}`") for c in keep], "keep_id", "group_size",
        (F.col("row") == F.col("keep_row")).alias("kept"), F.col("sha256").alias("text_sha256"),
    )
