"""Benchmark decontamination over a distributed positional inverted index.

The index is cut by documents: a segment holds whole documents of a few megabytes, and for each
term the sorted places at which it stands in the segment.  Between documents a place is left free,
so nothing matches across their border.  The index is stored once; a search passes over it with a
block of test items at a time.  For each window of test words the list of its globally rarest term
is taken, shifted by the term's offset, and intersected with the shifted lists of the other terms
from rare to frequent; what survives all of them is an exact occurrence.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmeter.llm.texts import PLAIN, as_bytes, free_names, id_and_text, map_texts, pieces, reach_workers, text_hash
from tripmeter.llm.words import Words

WINDOW = 13
#: Text of one segment; a longer document is a segment of its own.
SEGMENT_BYTES = 4 << 20
#: Test words that one pass over the index looks for.
BLOCK_WORDS = 1 << 20
#: Bits of the filter that keeps postings of terms which no test item has out of the index. Its
#: size is fixed: a large test set makes it let more terms through, not grow.
FILTER_BITS = 1 << 22
_SCHEMA = "segment bigint, doc_ids array<bigint>, text_hashes array<bigint>, n_words array<int>, terms array<bigint>, counts array<int>, places array<int>"


def term_filter(items: DataFrame) -> np.ndarray:
    """Bitmap over hashes of the test items' words, FILTER_BITS long."""
    hashed = map_texts(items.select(F.col("text").cast("string"), F.lit(0).alias("doc_id")), _slots, "slots array<int>")
    slots = [r[0] for r in hashed.select(F.explode("slots").alias("slot")).distinct().toLocalIterator()]
    out = np.zeros(FILTER_BITS, bool)
    out[slots] = True
    return np.packbits(out)


def _slots(texts: list[bytes | None]) -> list:
    words = Words(texts, PLAIN)
    slots = (words.hashes() % np.uint64(FILTER_BITS)).astype(np.int32)
    return [[np.unique(slots[a:b]) for a, b in zip(words.first[:-1], words.first[1:], strict=True)]]


def build_index(docs: DataFrame, path: str, only: np.ndarray | None = None) -> DataFrame:
    """The index of all ``docs``, stored at ``path`` (a folder that all executors share).

    One row a segment: its documents and their words, its terms (hashes, sorted), how many places
    each has, and the places term by term.  ``only`` is a :func:`term_filter`; without it all terms
    are kept.  A null text has no words; rows that repeat are documents of their own.
    """
    spark = reach_workers(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        admitted = None if only is None else np.unpackbits(only).astype(bool)
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for begin, end in pieces(batch.column(1), SEGMENT_BYTES):
                part = batch.slice(begin, end - begin)
                terms, places, sizes, base = [], [], [], 0
                for a, b in pieces(part.column(1)):
                    words = Words(as_bytes(part.column(1).slice(a, b - a)), PLAIN)
                    hashes = words.hashes()
                    at = np.arange(len(words)) + words.owner() + base
                    if admitted is not None:
                        chosen = admitted[hashes % np.uint64(FILTER_BITS)]
                        hashes, at = hashes[chosen], at[chosen]
                    terms.append(hashes.view(np.int64))
                    places.append(at)
                    sizes.append(words.counts)
                    base += len(words) + (b - a)
                term, place = np.concatenate(terms), np.concatenate(places)
                order = np.argsort(term, kind="stable")
                distinct, counts = np.unique(term, return_counts=True)
                made = [distinct, counts.astype(np.int32), place[order].astype(np.int32)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([number], pa.int64()),
                        _one_row(part.column(0)),
                        _one_row(part.column(2)),
                        _one_row(pa.array(np.concatenate(sizes).astype(np.int32))),
                        *[_one_row(pa.array(x)) for x in made],
                    ],
                    names=["segment", "doc_ids", "text_hashes", "n_words", "terms", "counts", "places"],
                )
                number += 1

    id_and_text(docs, text_hash().alias("text_hash")).mapInArrow(run, _SCHEMA).write.parquet(path)
    return spark.read.parquet(path)


def _one_row(values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


@dataclass
class Query:
    """Windows of a block of test items, each with its terms from rare to frequent.

    Window i belongs to item ``item[i]``, starts at its word ``start[i]`` and has ``size[i]`` words;
    ``terms[i, r]`` is its r-th rarest term and ``shifts[i, r]`` the term's offset (-1: none).
    """

    item: np.ndarray
    start: np.ndarray
    size: np.ndarray
    terms: np.ndarray
    shifts: np.ndarray


def plan_windows(items: list[np.ndarray], frequency: dict[int, int], window: int) -> Query:
    """All windows that can occur: those without a term the index lacks."""
    item, start, size, terms, shifts = [], [], [], [], []
    for i, words in enumerate(items):
        n = min(window, len(words))
        if not n:
            continue
        often = np.array([frequency.get(w, 0) for w in words.tolist()], np.int64)
        for s in range(len(words) - n + 1):
            own = often[s:s + n]
            if own.min() == 0:
                continue
            order = np.argsort(own, kind="stable")
            item.append(i)
            start.append(s)
            size.append(n)
            terms.append(np.pad(words[s:s + n][order], (0, window - n)))
            shifts.append(np.pad(order, (0, window - n), constant_values=-1))
    shape = (len(item), window)
    return Query(
        np.array(item, np.int64), np.array(start, np.int64), np.array(size, np.int64),
        np.array(terms, np.int64).reshape(shape), np.array(shifts, np.int64).reshape(shape),
    )


class Segment:
    """One row of the index."""

    def __init__(self, terms: np.ndarray, counts: np.ndarray, places: np.ndarray, n_words: np.ndarray) -> None:
        self.terms, self.places = terms, places
        self.begins = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
        self.doc_begins = np.concatenate([[0], np.cumsum(n_words.astype(np.int64) + 1)])
        # The term at each place, to intersect a shifted list with the list of another term.
        self.at = np.zeros(int(self.doc_begins[-1]) + 1, np.int32)
        self.at[places] = np.repeat(np.arange(1, len(terms) + 1, dtype=np.int32), counts)

    def number(self, terms: np.ndarray) -> np.ndarray:
        """Position of each term in ``terms``, -1 where the segment lacks it."""
        if not len(self.terms):
            return np.full(terms.shape, -1)
        found = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        return np.where(self.terms[found] == terms, found, -1)

    def occurrences(self, query: Query) -> tuple[np.ndarray, np.ndarray]:
        """(window, place of its first word) of every exact occurrence."""
        numbers = self.number(query.terms)
        present = ((numbers >= 0) | (query.shifts < 0)).all(axis=1)
        windows = np.flatnonzero(present)
        windows_out, places_out = [], []
        for part in np.array_split(windows, max(1, len(windows) // 4096)):
            rarest = numbers[part, 0]
            counts = self.begins[rarest + 1] - self.begins[rarest]
            which = np.repeat(part, counts)
            inside = np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts)
            place = self.places[np.repeat(self.begins[rarest], counts) + inside].astype(np.int64) - query.shifts[which, 0]
            for r in range(1, query.terms.shape[1]):
                shift = query.shifts[which, r]
                at = np.clip(place + shift, 0, len(self.at) - 1)
                same = (shift < 0) | ((self.at[at] == numbers[which, r] + 1) & (place >= 0))
                which, place = which[same], place[same]
                if not len(which):
                    break
            windows_out.append(which)
            places_out.append(place)
        if not windows_out:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(windows_out), np.concatenate(places_out)

    def near(self, words: np.ndarray, frequency: dict[int, int], within: int) -> np.ndarray:
        """Places of the rarest word that have every other word at most ``within`` words away, in the same document."""
        distinct = np.unique(words)
        order = sorted(range(len(distinct)), key=lambda i: (frequency.get(int(distinct[i]), 0), i))
        numbers = self.number(distinct[order])
        if not len(numbers) or (numbers < 0).any():
            return np.zeros(0, np.int64)
        lists = [self.places[self.begins[n]:self.begins[n + 1]].astype(np.int64) for n in numbers]
        place = lists[0]
        doc = np.searchsorted(self.doc_begins, place, side="right") - 1
        for other in lists[1:]:
            low = np.maximum(place - within, self.doc_begins[doc])
            high = np.minimum(place + within, self.doc_begins[doc + 1] - 1)
            some = np.searchsorted(other, high, side="right") > np.searchsorted(other, low)
            place, doc = place[some], doc[some]
        return place


def frequencies(index: DataFrame) -> DataFrame:
    """``term, n``: places of each term in the whole index."""
    pairs = index.select(F.explode(F.arrays_zip("terms", "counts")).alias("p"))
    return pairs.groupBy(F.col("p.terms").alias("term")).agg(F.sum("p.counts").alias("n"))


def _blocks(index: DataFrame, items: DataFrame) -> Iterator[tuple[list[str], list[np.ndarray], dict[int, int]]]:
    """Ids and words of bounded blocks of items, with the frequencies of their terms."""
    worded = map_texts(
        items.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text")),
        _hashes, "words array<bigint>", keep=("item_id",),
    ).where(F.size("words") > 0)
    total = worded.agg(F.sum(F.size("words"))).first()[0] or 0
    n = -(-total // BLOCK_WORDS)
    counted = frequencies(index)
    for i in range(n):
        block = worded.where(F.pmod(F.xxhash64("item_id", "words"), F.lit(n)) == i)
        rows = sorted((r["item_id"] or "", tuple(r["words"])) for r in block.collect())
        wanted = block.select(F.explode("words").alias("term")).distinct()
        often = {r["term"]: r["n"] for r in counted.join(wanted, "term", "left_semi").collect()}
        yield [r[0] for r in rows], [np.array(r[1], np.int64) for r in rows], often


def _hashes(texts: list[bytes | None]) -> list:
    words = Words(texts, PLAIN)
    hashes = words.hashes().view(np.int64)
    return [[hashes[a:b] for a, b in zip(words.first[:-1], words.first[1:], strict=True)]]


def _segments(batch: pa.RecordBatch) -> Iterator[tuple[int, Segment]]:
    columns = {n: batch.column(i) for i, n in enumerate(["segment", "n_words", "terms", "counts", "places"])}
    for i in range(batch.num_rows):
        n_words, terms, counts, places = (columns[n][i].values.to_numpy() for n in ("n_words", "terms", "counts", "places"))
        yield columns["segment"][i].as_py(), Segment(terms, counts, places, n_words)


_SPANS = "segment bigint, ordinal int, item_id string, item_start int, start int, size int"


def phrase_matches(index: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Exact matches: runs of words that a document shares with a test item.

    ``segment, ordinal`` name the document in the index; ``size`` words from its word ``start`` are
    those of the item from ``item_start``.  Runs have at least ``window`` words, or are a whole item
    of fewer; items without words match nothing.
    """
    spark = reach_workers(index.sparkSession)
    found = spark.createDataFrame([], _SPANS)
    for names, words, often in _blocks(index, items):
        query = plan_windows(words, often, window)

        def run(batches: Iterator[pa.RecordBatch], names=names, query=query) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for number, segment in _segments(batch):
                    which, place = segment.occurrences(query)
                    if not len(which):
                        continue
                    item, start, size = query.item[which], query.start[which], query.size[which]
                    # Windows of one item that follow each other are one run.
                    diagonal = place - start
                    order = np.lexsort((place, diagonal, item))
                    item, start, size, place, diagonal = (x[order] for x in (item, start, size, place, diagonal))
                    new = np.ones(len(order), bool)
                    new[1:] = (item[1:] != item[:-1]) | (diagonal[1:] != diagonal[:-1]) | (place[1:] != place[:-1] + 1)
                    first = np.flatnonzero(new)
                    last = np.append(first[1:], len(order)) - 1
                    doc = np.searchsorted(segment.doc_begins, place[first], side="right") - 1
                    columns = [
                        np.full(len(first), number), doc.astype(np.int32), [names[i] for i in item[first]],
                        start[first].astype(np.int32), (place[first] - segment.doc_begins[doc]).astype(np.int32),
                        (place[last] - place[first] + size[first]).astype(np.int32),
                    ]
                    types = [pa.int64(), pa.int32(), pa.string(), pa.int32(), pa.int32(), pa.int32()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                        names=["segment", "ordinal", "item_id", "item_start", "start", "size"],
                    )

        found = found.unionByName(index.select("segment", "n_words", "terms", "counts", "places").mapInArrow(run, _SPANS))
    return found


def proximity_matches(index: DataFrame, items: DataFrame, within: int) -> DataFrame:
    """``segment, ordinal, item_id, place``: where an item's rarest word has all its other words within reach."""
    spark = reach_workers(index.sparkSession)
    schema = "segment bigint, ordinal int, item_id string, place int"
    found = spark.createDataFrame([], schema)
    for names, words, often in _blocks(index, items):

        def run(batches: Iterator[pa.RecordBatch], names=names, words=words, often=often) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for number, segment in _segments(batch):
                    for name, own in zip(names, words, strict=True):
                        place = segment.near(own, often, within)
                        doc = np.searchsorted(segment.doc_begins, place, side="right") - 1
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(np.full(len(place), number)), pa.array(doc.astype(np.int32)),
                                pa.array([name] * len(place), pa.string()), pa.array((place - segment.doc_begins[doc]).astype(np.int32)),
                            ],
                            names=["segment", "ordinal", "item_id", "place"],
                        )

        found = found.unionByName(index.select("segment", "n_words", "terms", "counts", "places").mapInArrow(run, schema))
    return found


def indexed_documents(index: DataFrame) -> DataFrame:
    """``segment, ordinal, doc_id, text_hash, n_words`` of every document in the index."""
    docs = index.select("segment", F.posexplode(F.arrays_zip("doc_ids", "text_hashes", "n_words")).alias("ordinal", "d"))
    return docs.select(
        "segment", "ordinal", F.col("d.doc_ids").alias("doc_id"), F.col("d.text_hashes").alias("text_hash"),
        F.col("d.n_words").cast("long").alias("n_words"),
    )


def words_in(spans: Column) -> Column:
    """Words in the union of sorted spans (start, size)."""
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
    step = lambda s, x: F.struct(
        F.greatest(s["end"], x["start"] + x["size"]).alias("end"),
        (s["n"] + F.greatest(F.lit(0), x["start"] + x["size"] - F.greatest(s["end"], x["start"]))).alias("n"),
    )
    return F.aggregate(spans, zero, step, lambda s: s["n"])


def contamination(docs: DataFrame, items: DataFrame, scratch: str, window: int = WINDOW) -> DataFrame:
    """``doc_id, text_hash, n_words, n_hit, items`` of every document.

    ``n_hit`` counts the document's words inside occurrences of test windows, ``items`` lists the
    ids of items with occurring windows, sorted as strings.  Items that share an id are one item; a
    null id reads as an empty one.  Null and empty texts have no words; documents that repeat give
    a row each.  ``scratch`` is a folder that all executors share.
    """
    index = build_index(docs, f"{scratch}/index", term_filter(items))
    phrase_matches(index, items, window).write.parquet(f"{scratch}/matches")
    matches = docs.sparkSession.read.schema(_SPANS).parquet(f"{scratch}/matches")
    per_doc = matches.groupBy("segment", "ordinal").agg(
        F.array_sort(F.collect_set(F.struct("start", "size"))).alias("spans"), F.array_sort(F.collect_set("item_id")).alias("items")
    )
    return indexed_documents(index).join(per_doc, ["segment", "ordinal"], "left").select(
        "doc_id", "text_hash", "n_words",
        F.coalesce(words_in(F.col("spans")), F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def contaminated() -> Column:
    """At least a twentieth of the words is hit."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def without_contaminated(docs: DataFrame, items: DataFrame, scratch: str, window: int = WINDOW) -> DataFrame:
    """``docs`` without the documents that :func:`contaminated` is true for."""
    own_id, own_hash = free_names(docs, "_id", "_hash")
    found = contamination(docs, items, scratch, window).where(contaminated())
    found = found.select(F.col("doc_id").alias(own_id), F.col("text_hash").alias(own_hash))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(own_id)) & (text_hash() == F.col(own_hash))
    return docs.join(found, same, "left_anti")
