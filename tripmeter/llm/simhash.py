"""Near duplicates by SimHash fingerprints.

Fingerprints are embedded by the number of set bits in each of 32 segments of two bits.  The
Manhattan distance of two embeddings is at most the number of differing bits, so links are looked
for in a grid over the embedding: its coordinates form eight groups, and as at most three groups can
differ within three bits, linked fingerprints agree exactly in five groups at least and meet in
one of the 56 grids over five groups.  Where the coordinates of a cell are equal, the sums of the
others differ by three at most: rows of a cell are sorted by their sum and each probes that range
only.  The Manhattan bound drops most of the rest, and what is left is verified bit by bit.  Equal
fingerprints are one node, and of each cell only a spanning forest of its links is kept, so copies
never become pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmeter.llm.graphs import components
from tripmeter.llm.texts import LOWER, free_names, id_and_text, map_texts, reach_workers, text_hash

SEED = 42
#: Rows of a cell that are compared in one unit of work; larger cells are cut into blocks, and every two blocks are a unit.
BLOCK = 2048
#: Groups of coordinates beyond those that may differ. One more means finer cells, so fewer chance meetings, and more grids.
KEY_GROUPS = 5
_EVERY_SECOND = 0x5555555555555555


def fingerprint_of(words: list[bytes], size: int, seed: int = SEED) -> int:
    """The fingerprint of one list of words."""
    found = shingle_hashes(b" ".join(words), len(words), size, seed)
    return int(majority(found)) if len(found) else 0


def shingle_hashes(plain: bytes, n: int, size: int, seed: int) -> np.ndarray:
    """XXH64 of each run of ``size`` words of ``n`` words parted by single spaces."""
    import xxhash

    if n == 0:
        return np.zeros(0, np.uint64)
    digest = xxhash.xxh64_intdigest
    if n <= size:
        return np.array([digest(plain, seed)], np.uint64)
    gaps = np.flatnonzero(np.frombuffer(plain, np.uint8) == 32)
    begins = [0, *(gaps[: n - size] + 1).tolist()]
    ends = [*gaps[size - 1:].tolist(), len(plain)]
    return np.array([digest(plain[a:b], seed) for a, b in zip(begins, ends, strict=True)], np.uint64)


def majority(hashes: np.ndarray) -> np.uint64:
    """Bits set in over half of the values."""
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    over = bits.sum(axis=0, dtype=np.int64) * 2 > len(hashes)
    return np.packbits(over, bitorder="little").view("<u8")[0]


def fingerprints(docs: DataFrame, size: int = 3, seed: int = SEED, *keep: str) -> DataFrame:
    """``doc_id, fp`` (a signed 64-bit number) of every whole text.

    A-Z are lower-cased; fewer than ``size`` words are one shingle; a null text, or one without
    words, has fingerprint 0.  Rows that repeat give a row each.
    """

    def compute(texts: list[bytes | None]) -> list:
        out = np.zeros(len(texts), np.uint64)
        for i, text in enumerate(texts):
            words = (text or b"").translate(LOWER).split()
            found = shingle_hashes(b" ".join(words), len(words), size, seed)
            if len(found):
                out[i] = majority(found)
        return [out.view(np.int64)]

    return map_texts(id_and_text(docs, *keep), compute, "fp bigint", keep=("doc_id", *keep))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def embedding(fp: Column) -> Column:
    """Set bits of each of the 32 segments, two bits a segment."""
    moved, even = F.shiftrightunsigned(fp, 1), F.lit(_EVERY_SECOND)
    two = moved.bitwiseAND(fp).bitwiseAND(even)
    one = moved.bitwiseXOR(fp).bitwiseAND(even)
    return F.shiftleft(two, 1).bitwiseOR(one)


def grids(max_bits: int, key_groups: int = KEY_GROUPS) -> list[int]:
    """Masks of the coordinates that each grid looks at: ``key_groups`` of ``key_groups + max_bits`` groups."""
    groups = key_groups + max_bits
    edges = [round(i * 32 / groups) for i in range(groups + 1)]
    masks = [sum(3 << 2 * s for s in range(a, b)) for a, b in zip(edges[:-1], edges[1:], strict=True)]
    return [_signed(sum(chosen)) for chosen in combinations(masks, key_groups)]


def manhattan(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Manhattan distance of the embeddings of fingerprints."""
    total = np.zeros(len(a), np.uint8)
    even = np.uint64(_EVERY_SECOND)
    ca, cb = a - ((a >> np.uint64(1)) & even), b - ((b >> np.uint64(1)) & even)
    # Per segment |x - y| for x, y in 0..2: as thermometer codes the distance is the number of differing bits.
    code = lambda c: (c & ~even) | (((c | (c >> np.uint64(1))) & even))
    total += np.bitwise_count(code(ca) ^ code(cb))
    return total


class Forest:
    """Which members of a batch are linked already."""

    def __init__(self, n: int) -> None:
        self.up = list(range(n))

    def find(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        a, b = self.find(i), self.find(j)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True


def links_in(units: np.ndarray, fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forests of the links within each unit; rows are sorted by unit and set bits."""
    forest = Forest(len(fps))
    sums = np.bitwise_count(fps).astype(np.int64)
    left, right = [], []
    at = np.arange(len(fps))
    step = 0
    while True:
        step += 1
        at = at[at < len(fps) - step]
        # The range probe: sums only grow within a unit, so a row that is out of reach stays so.
        at = at[(units[at] == units[at + step]) & (sums[at + step] - sums[at] <= max_bits)]
        if not len(at):
            break
        a, b = fps[at], fps[at + step]
        near = at[manhattan(a, b) <= max_bits]
        near = near[np.bitwise_count(fps[near] ^ fps[near + step]) <= max_bits]
        for i in near.tolist():
            if fps[i] != fps[i + step] and forest.join(i, i + step):
                left.append(i)
                right.append(i + step)
    return fps[np.array(left, np.int64)], fps[np.array(right, np.int64)]


def near_links(fps: DataFrame, max_bits: int, scratch: str, block: int = BLOCK) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints within ``max_bits`` of one another.

    Not every near pair is a row, but every near pair is connected by rows.
    """
    spark = reach_workers(fps.sparkSession)
    masks = grids(max_bits)
    coordinates = embedding(F.col("fp"))
    cells = fps.select("fp", F.posexplode(F.array(*[coordinates.bitwiseAND(F.lit(m)) for m in masks])).alias("grid", "cell"))
    shared = cells.groupBy("grid", "cell").agg(F.count("*").alias("n")).where("n > 1")
    parts = F.ceil(F.col("n") / block).cast("int")
    own = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    # Spark sizes the cells as if there were one a fingerprint, not one a grid, and would broadcast them: they are merged.
    met = (
        cells.join(shared.hint("merge"), ["grid", "cell"])
        .withColumn("parts", parts)
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select("fp", F.xxhash64("grid", "cell", F.least("own", "other"), F.greatest("own", "other")).alias("unit"))
    )
    # A unit is a hash; should two of them be equal, more rows are compared and nothing is lost.
    sorted_units = met.repartition("unit").sortWithinPartitions("unit", F.bit_count("fp"), "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest_units, rest_fps = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        for batch in batches:
            units = np.concatenate([rest_units, batch.column(1).to_numpy(zero_copy_only=False)])
            found = np.concatenate([rest_fps, batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)])
            if not len(units):
                continue
            whole = int(np.searchsorted(units, units[-1]))  # the last unit may go on in the next batch
            rest_units, rest_fps = units[whole:], found[whole:]
            a, b = links_in(units[:whole], found[:whole], max_bits)
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])
        a, b = links_in(rest_units, rest_fps, max_bits)
        yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    sorted_units.mapInArrow(run, "a bigint, b bigint").write.parquet(scratch)
    return spark.read.parquet(scratch)


def near_duplicates(docs: DataFrame, scratch: str, size: int = 3, max_bits: int = 3, *keep: str) -> DataFrame:
    """``doc_id, fp, root, component_id`` of every row: the smallest id reachable over links of ``max_bits`` bits or fewer.

    ``root`` is a fingerprint that names the component.

    Rows without an id take part and may connect others; a component without any id has a null
    ``component_id``.  Rows that repeat give a row each; an empty table gives no rows; of other
    columns only ``keep`` are returned.  ``scratch`` is a folder that all executors share.
    """
    spark = docs.sparkSession
    fingerprints(docs, size, SEED, *keep).write.parquet(f"{scratch}/fingerprints")
    marked = spark.read.parquet(f"{scratch}/fingerprints")
    marked.groupBy("fp").agg(F.min("doc_id").alias("least")).write.parquet(f"{scratch}/distinct")
    nodes = spark.read.parquet(f"{scratch}/distinct")
    links = near_links(nodes.select("fp"), max_bits, f"{scratch}/links")
    roots = components(links, f"{scratch}/components").withColumnRenamed("node", "fp")
    rooted = nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(least, "root").select("fp", "root", "component_id")
    return marked.join(named, "fp")


def one_of_each(docs: DataFrame, scratch: str, size: int = 3, max_bits: int = 3) -> DataFrame:
    """``docs`` with one document of each component: the smallest id, of rows that share it one with the least text hash.

    Rows without an id stay only where their component has no id.
    """
    columns = docs.columns
    key, own_hash, number, no_id = free_names(docs, "_key", "_hash", "_n", "_no_id")
    named = docs.withColumns({key: F.coalesce(F.col("doc_id").cast("long"), F.lit(0)), own_hash: text_hash()})
    found = near_duplicates(named, scratch, size, max_bits, own_hash)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", F.col(own_hash).alias("own"))).alias("first")
    chosen = found.groupBy("root").agg(first).select(
        F.coalesce("first.doc_id", F.lit(0)).alias(key), F.col("first.own").alias(own_hash), F.col("first.no_id").alias(no_id)
    )
    met = named.join(chosen, [key, own_hash]).where(F.col("doc_id").isNull() == F.col(no_id))
    # Equal rows: any of them.
    again = Window.partitionBy(key, own_hash).orderBy(*[F.col(f"`{c}`") for c in columns if c != "text"])
    return met.withColumn(number, F.row_number().over(again)).where(F.col(number) == 1).select(*[f"`{c}`" for c in columns])


def as_hex(fp: Column) -> Column:
    """16 lowercase hex digits."""
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
