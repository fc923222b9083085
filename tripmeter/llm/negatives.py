"""Hard negatives by rotated one-bit codes.

A vector is rotated by signs and Hadamard transforms.  Its code is the sign of each rotated component;
stored beside it is the vector's alignment with the code (its length along the code's direction).  What
the code leaves over is coded again the same way, ``LEVELS`` times, and the length of the last rest is
stored.  An anchor is cut into bit planes, so the inner product of a code with it is a few popcounts.
The estimate is off by no more than the rest's length times the anchor's (Cauchy-Schwarz), plus what
the bit planes lose; both are computed, so every pair has an interval that holds its score for certain.
Only pairs whose interval reaches what is still wanted are scored, in integers.

Codes and whole vectors are stored once.  Anchors are taken in blocks of bounded size against all rows:
one pass finds the positives of a block, a second one the negatives between the limits that the
positives' scores set.  A task keeps the best few of each anchor; nothing else leaves it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmeter.llm.texts import reach_workers

LEVELS = 3
PLANES = 5
SEED = 11
#: Components of the anchors of one block, and rows and anchors that are compared at once.
BLOCK_VALUES = 1 << 21
ROWS_AT_ONCE = 2048
ANCHORS_AT_ONCE = 128
#: Components of the pairs that are scored at once.
VALUES_AT_ONCE = 1 << 21
_LONG = np.iinfo(np.int64)
_CODES = "row bigint, id bigint, label bigint, anchor boolean, vector array<double>, bits array<bigint>, alignment array<double>, rest double"


def padded(size: int) -> int:
    """Components of a rotated vector: a power of two, 64 at least."""
    return 1 << max(6, (max(1, size) - 1).bit_length())


def rotate(vectors: np.ndarray) -> np.ndarray:
    """Rows rotated: three rounds of random signs and a Hadamard transform, lengths and angles kept."""
    n = vectors.shape[1]
    signs = np.random.default_rng(SEED).choice([-1.0, 1.0], (3, n))
    out = vectors
    for s in signs:
        out = out * s
        width = 1
        while width < n:
            pairs = out.reshape(len(out), -1, 2, width)
            out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(len(out), n)
            width *= 2
        out = out / np.sqrt(n)
    return out


def pack(bits: np.ndarray) -> np.ndarray:
    """Rows of booleans (a multiple of 64) as unsigned words."""
    return np.packbits(bits, axis=-1).view(np.uint64)


def encode(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes (rows, levels, words), alignments (rows, levels) and lengths of the last rest."""
    rest, n = rotate(vectors), vectors.shape[1]
    bits = np.empty((len(vectors), LEVELS, n // 64), np.uint64)
    alignment = np.empty((len(vectors), LEVELS))
    for level in range(LEVELS):
        positive = rest >= 0
        bits[:, level] = pack(positive)
        alignment[:, level] = np.abs(rest).mean(axis=1)
        rest = rest - np.where(positive, 1.0, -1.0) * alignment[:, level, None]
    return bits, alignment, np.sqrt((rest * rest).sum(axis=1))


@dataclass
class Anchors:
    """A block of anchors: rows, labels and vectors; ``planes`` (anchors, planes, words) with step and least value."""

    rows: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray

    def __post_init__(self) -> None:
        rotated = rotate(self.vectors)
        self.low = rotated.min(axis=1)
        self.step = (rotated.max(axis=1) - self.low) / ((1 << PLANES) - 1)
        unit = np.where(self.step > 0, self.step, 1.0)[:, None]
        level = np.clip(np.rint(np.nan_to_num((rotated - self.low[:, None]) / unit)), 0, (1 << PLANES) - 1).astype(np.int64)
        self.planes = np.stack([pack((level >> p) & 1 == 1) for p in range(PLANES)], axis=1)
        near = self.low[:, None] + self.step[:, None] * level
        self.total = near.sum(axis=1)
        self.lost = np.abs(rotated - near).sum(axis=1)
        self.length = np.sqrt((self.vectors * self.vectors).sum(axis=1))

    def intervals(self, bits: np.ndarray, alignment: np.ndarray, rest: np.ndarray, which: slice) -> tuple[np.ndarray, np.ndarray]:
        """Bounds of the score of each row with each anchor: what popcounts estimate, less and plus what they may miss."""
        planes = self.planes[which]
        estimate = np.zeros((len(bits), len(planes)))
        for level in range(LEVELS):
            counts = np.zeros((len(bits), len(planes)), np.int32)
            for p in range(PLANES):
                for word in range(bits.shape[2]):
                    counts += np.bitwise_count(bits[:, level, word, None] & planes[None, :, p, word]).astype(np.int32) << p
            ones = np.bitwise_count(bits[:, level]).sum(axis=1, dtype=np.int64)[:, None]
            along = 2 * (self.low[which] * ones + self.step[which] * counts) - self.total[which]
            estimate += alignment[:, level, None] * along
        size = alignment.sum(axis=1)[:, None]
        miss = rest[:, None] * self.length[which] + size * self.lost[which]
        miss += 1e-9 * (np.abs(estimate) + miss) + 1e-6
        return estimate - miss, estimate + miss


def scores(rows: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    """Exact integer inner products of pairs of rows; one beyond a long is the nearest long."""
    most = np.abs(rows).max(initial=0.0) * np.abs(anchors).max(initial=0.0) * max(1, rows.shape[1])
    if most < 2.0**53:
        return np.einsum("ij,ij->i", rows, anchors).astype(np.int64)
    exact = (sum(int(x) * int(y) for x, y in zip(a, b, strict=True)) for a, b in zip(rows.tolist(), anchors.tolist(), strict=True))
    return np.array([min(max(s, _LONG.min + 1), _LONG.max) for s in exact], np.int64)


def prepared(table: DataFrame, path: str, vector: str, row_id: Column, label: Column, anchor: Column, scale: int = 256) -> DataFrame:
    """Rows that take part, stored with their codes."""
    reach_workers(table.sparkSession)
    values = F.col(vector).cast("array<double>")
    whole = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    frame = table.select(
        F.monotonically_increasing_id().alias("row"), row_id.cast("long").alias("id"), label.cast("long").alias("label"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"), values.alias("vector"),
    ).where(F.col("label").isNotNull() & F.col("vector").isNotNull() & whole)
    size = padded(frame.agg(F.max(F.size("vector"))).first()[0] or 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(begin, ROWS_AT_ONCE)
                column = part.column(4)
                lengths = np.diff(column.offsets.to_numpy())
                vectors = np.zeros((len(lengths), size))
                vectors[np.arange(size) < lengths[:, None]] = np.clip(np.floor(column.flatten().to_numpy() * scale), -1e300, 1e300)
                bits, alignment, rest = encode(vectors)
                made = [_lists(vectors), _lists(bits.reshape(len(bits), -1).view(np.int64)), _lists(alignment), pa.array(rest)]
                yield pa.RecordBatch.from_arrays([*part.columns[:4], *made], names=["row", "id", "label", "anchor", "vector", "bits", "alignment", "rest"])

    frame.mapInArrow(run, _CODES).write.parquet(path)
    return table.sparkSession.read.parquet(path)


def _lists(values: np.ndarray) -> pa.Array:
    n, width = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * width, pa.int32()), pa.array(np.ascontiguousarray(values).reshape(-1)))


def _matrix(column: pa.Array, rows: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(rows, -1)


@dataclass
class Best:
    """The first ``keep`` of each slot so far: by score from high to low, then by id (none last)."""

    keep: int
    slots: int

    def __post_init__(self) -> None:
        self.slot, self.score, self.id, self.row = (np.zeros(0, np.int64) for _ in range(4))
        self.known = np.zeros(0, bool)
        #: The score below which nothing can get into a slot any more.
        self.enough = np.full(self.slots, float(-np.inf))

    def add(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray, known: np.ndarray, row: np.ndarray) -> None:
        slot, score, ids, row = (np.concatenate(x) for x in ((self.slot, slot), (self.score, score), (self.id, ids), (self.row, row)))
        known = np.concatenate([self.known, known])
        order = np.lexsort((row, ids, ~known, -score, slot))
        slot = slot[order]
        begin = np.searchsorted(slot, slot)
        first = np.arange(len(slot)) - begin < self.keep
        order = order[first]
        self.slot, self.score, self.id, self.known, self.row = slot[first], score[order], ids[order], known[order], row[order]
        full = np.flatnonzero(np.bincount(self.slot, minlength=self.slots) >= self.keep)
        ends = np.searchsorted(self.slot, full, side="right") - 1
        self.enough[full] = self.score[ends]


_FOUND = "slot bigint, id bigint, score bigint, row bigint"


def search(codes: DataFrame, anchors: Anchors, slot_anchor: np.ndarray, low: np.ndarray, high: np.ndarray, same: bool, keep: int) -> DataFrame:
    """``slot, id, score, row``: the first ``keep`` rows of every slot that each task finds.

    A slot asks for rows of its anchor's label (``same``; the anchor itself is left out) or of another
    one, with a score from ``low`` to ``high``.
    """

    wanted = max(1, int(np.bincount(slot_anchor).max()))
    # The slots of each anchor, -1 beyond.
    slots = np.full((len(anchors.rows), wanted), -1)
    order = np.argsort(slot_anchor, kind="stable")
    place = np.arange(len(order)) - np.searchsorted(slot_anchor[order], slot_anchor[order])
    slots[slot_anchor[order], place] = order

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(keep, len(slot_anchor)) for _ in range(0, len(anchors.rows), ANCHORS_AT_ONCE)]
        at_once = max(1, VALUES_AT_ONCE // anchors.vectors.shape[1])
        for batch in growing(batches):
            n = batch.num_rows
            row, ids, label = (batch.column(i).fill_null(0).to_numpy(zero_copy_only=False) for i in range(3))
            known = batch.column(1).is_valid().to_numpy(zero_copy_only=False)
            vectors, alignment, rest = _matrix(batch.column(3), n), _matrix(batch.column(5), n), batch.column(6).to_numpy()
            bits = _matrix(batch.column(4), n).view(np.uint64).reshape(n, LEVELS, -1)
            for part, own in enumerate(best):
                first = part * ANCHORS_AT_ONCE
                which = slice(first, first + ANCHORS_AT_ONCE)
                least, most = anchors.intervals(bits, alignment, rest, which)
                open_ = (label[:, None] == anchors.labels[which]) == same
                if same:
                    open_ &= row[:, None] != anchors.rows[which]
                # What any slot of the anchor still takes; a bound that is no number leaves a pair open.
                there = slots[which] >= 0
                floor = np.where(there, np.maximum(low, own.enough)[slots[which]], np.inf).min(axis=1)
                roof = np.where(there, high[slots[which]], -np.inf).max(axis=1)
                open_ &= ~((most < floor) | (least > roof))
                at, of = np.nonzero(open_)
                for a in range(0, len(at), at_once):
                    r, anchor = at[a:a + at_once], of[a:a + at_once] + first
                    score = scores(vectors[r], anchors.vectors[anchor])
                    for j in range(wanted):
                        slot = slots[anchor, j]
                        inside = (slot >= 0) & (score >= low[slot]) & (score <= high[slot]) & (score >= own.enough[slot])
                        if inside.any():
                            own.add(slot[inside], score[inside], ids[r[inside]], known[r[inside]], row[r[inside]])
        for own in best:
            columns = [pa.array(own.slot), pa.array(own.id, pa.int64(), mask=~own.known), pa.array(own.score), pa.array(own.row)]
            yield pa.RecordBatch.from_arrays(columns, names=["slot", "id", "score", "row"])

    return codes.select("row", "id", "label", "vector", "bits", "alignment", "rest").mapInArrow(run, _FOUND)


def growing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Small batches first, so that limits are up before most rows come."""
    size = 64
    for whole in batches:
        begin = 0
        while begin < whole.num_rows:
            yield whole.slice(begin, size)
            begin += size
            size = min(2 * size, ROWS_AT_ONCE)


def _ranked(found: DataFrame, keep: int) -> DataFrame:
    """The first ``keep`` of each slot over all tasks, numbered from 1."""
    order = Window.partitionBy("slot").orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= keep)


_NEGATIVES = (
    "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint, "
    "anchor_row bigint, positive_row bigint, negative_row bigint"
)


def hard_negatives(
    codes: DataFrame, scratch: str, positives: int = 5, negatives: int = 10, band: tuple[int, int] = (30, 90), block_values: int = BLOCK_VALUES
) -> DataFrame:
    """For each anchor of ``codes`` (see :func:`prepared`) and each of its positives, the hardest negatives.

    Positives are the first ``positives`` other rows of the anchor's label by score (higher first, ties
    by smaller id, rows without an id last); negatives the first ``negatives`` rows of other labels with
    ``band[0] * positive_score <= 100 * score <= band[1] * positive_score``.  A pair without any has no
    rows.  Rows that repeat are rows of their own, an anchor's copy may be its positive.  Shorter vectors
    end in zeros; a score beyond a long is the nearest long.  No rows give no rows.
    """
    spark = codes.sparkSession
    chosen = codes.where("anchor")
    shape = chosen.agg(F.count("*"), F.max(F.size("vector"))).first()
    blocks = max(1, -(-shape[0] * (shape[1] or 1) // block_values))
    for number in range(blocks):
        block = chosen.where(F.pmod(F.xxhash64("row"), F.lit(blocks)) == number).select("row", "id", "label", "vector").orderBy("row").toArrow()
        if not block.num_rows:
            continue
        columns = {c: block.column(c).combine_chunks() for c in block.column_names}
        rows = columns["row"].to_numpy()
        anchors = Anchors(rows, columns["label"].to_numpy(), _matrix(columns["vector"], len(rows)).astype(float))
        every = np.arange(len(rows))
        unbounded = np.full(len(rows), np.inf)
        folder = f"{scratch}/positives-{number}"
        _ranked(search(codes, anchors, every, -unbounded, unbounded, True, positives), positives).write.parquet(folder)
        pairs = spark.read.parquet(folder)
        # Bounded by the block: a few scores for each of its anchors.
        told = pairs.select("slot", "score", "row", "id").orderBy("slot", "rank").toArrow()
        slot_anchor, score = told.column("slot").to_numpy(), told.column("score").to_pylist()
        if not len(slot_anchor):
            continue
        low = np.array([float(-(-band[0] * s // 100)) for s in score])
        high = np.array([float(band[1] * s // 100) for s in score])
        ids = columns["id"].to_pylist()
        positive = spark.createDataFrame(
            [(i, ids[a], int(rows[a]), p, r, s) for i, (a, p, r, s) in enumerate(zip(slot_anchor.tolist(), told.column("id").to_pylist(), told.column("row").to_pylist(), score, strict=True))],
            "slot bigint, anchor_id bigint, anchor_row bigint, positive_id bigint, positive_row bigint, positive_score bigint",
        )
        _ranked(search(codes, anchors, slot_anchor, low, high, False, negatives), negatives).join(positive, "slot").select(
            "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"),
            "anchor_row", "positive_row", F.col("row").alias("negative_row"),
        ).write.mode("append").parquet(f"{scratch}/negatives")
    spark.createDataFrame([], _NEGATIVES).write.mode("append").parquet(f"{scratch}/negatives")
    return spark.read.schema(_NEGATIVES).parquet(f"{scratch}/negatives")
