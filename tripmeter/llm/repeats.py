"""Repeated windows of a fixed number of symbols over all documents, as Spark jobs.

Comparing every window with every other is out of the question, and so is a row per window.  The
windows of a text fall into runs: each window names its smallest gram by hash (its anchor), and
neighbouring windows that name the same gram at the same place are a run.  Equal windows name equal
grams, so

1. documents are dealt into blocks of a few megabytes, and each block gives its distinct runs, as
   anchor and hash;
2. an anchor that occurs once in the whole corpus belongs to windows that cannot repeat, and most
   text ends here;
3. runs of the other anchors are sent to a shard chosen by the anchor, so all places at which a
   window can be repeated meet in one shard; equal runs of a block are sent once, and of all blocks
   with equal runs one sends the text, the others its name;
4. the shard compares its runs (by the method of the caller) and returns spans;
5. each block gathers its documents' spans.

An anchor with very many different runs is split: its runs are dealt into parts, and every two
parts meet in a unit of their own.  No shard, unit or block grows with the corpus, and the text
crosses the network once, as all three passes over the blocks read the same shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tripmeter.llm.texts import as_bytes, id_and_text, pieces, reach_workers
from tripmeter.llm.words import Words, mix, windows

#: Text of a block, and text that a shard answers for (its runs are at most 3.5 times that).
BLOCK_BYTES = 4 << 20
SHARD_BYTES = 1 << 20
#: Text that is hashed at once.
PART_BYTES = 1 << 19
#: Different runs of one anchor in one part.
PART_RUNS = 4096
#: Bits of a place that are packed beside a gram; more than the places of one window.
_PLACE_BITS = np.uint64(28)


class Bytes(Words):
    """The bytes of texts as symbols."""

    def __init__(self, texts: list[bytes | None]) -> None:
        self.whole = b"".join(t or b"" for t in texts)
        self._sums = None
        self.data = np.frombuffer(self.whole, np.uint8)
        self.first = np.zeros(len(texts) + 1, np.int64)
        np.cumsum([len(t or b"") for t in texts], out=self.first[1:])

    def __len__(self) -> int:
        return len(self.data)

    def grams(self, size: int) -> np.ndarray:
        """A hash of ``size`` bytes (a multiple of 8) from each byte on."""
        n = len(self.data) - size + 1
        if n <= 0:
            return np.zeros(0, np.uint64)
        eight = np.array(np.ndarray((len(self.data) - 7,), "<u8", self.whole, 0, (1,)))
        out = eight[:n].copy()
        for i in range(8, size, 8):
            out *= np.uint64(0x9FB21C651E98DF25)
            out ^= out >> np.uint64(31)
            out += eight[i:i + n]
        return mix(out)

    def bytes_of(self, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return begin, end


class SingleSpaced(Words):
    """The words of texts as symbols; between words stands one space."""

    def __init__(self, texts: list[bytes | None]) -> None:
        super().__init__([b" ".join((t or b"").split()) for t in texts])

    def grams(self, size: int) -> np.ndarray:
        return windows(self.hashes(), size)

    def bytes_of(self, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.starts[begin], self.ends[end - 1]


@dataclass(frozen=True)
class Scheme:
    """Windows of ``window`` symbols, anchored by grams of ``gram``; ``symbols`` reads texts."""

    symbols: type
    window: int
    gram: int
    #: Whether the first place of a repeated window counts as repeated too.
    first_too: bool


@dataclass
class Runs:
    """Runs of a list of texts: text, first window, number of windows, anchor and a hash of the run."""

    text: np.ndarray
    begin: np.ndarray
    count: np.ndarray
    anchor: np.ndarray
    hash: np.ndarray

    def pick(self, which: np.ndarray) -> Runs:
        return Runs(*(getattr(self, f)[which] for f in ("text", "begin", "count", "anchor", "hash")))


def sliding_min(values: np.ndarray, size: int) -> np.ndarray:
    out, have = values, 1
    while have * 2 <= size:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    return out if have == size else np.minimum(out[: len(out) - (size - have)], out[size - have:])


def find_runs(symbols: Words, scheme: Scheme) -> Runs:
    """All runs of the texts in ``symbols``; ``begin`` counts from the start of the text."""
    empty = np.zeros(0, np.int64)
    if len(symbols) < scheme.window:
        return Runs(empty, empty, empty, empty.view(np.uint64), empty.view(np.uint64))
    grams = symbols.grams(scheme.gram)
    place_mask = np.uint64((1 << int(_PLACE_BITS)) - 1)
    # The low bits of a place tell it apart within reach of a window, however long the text is.
    keyed = (grams & ~place_mask) | (np.arange(len(grams), dtype=np.uint64) & place_mask)
    least = sliding_min(keyed, scheme.window - scheme.gram + 1)
    start = np.arange(len(least), dtype=np.uint64)
    place = (start + ((least - start) & place_mask)).astype(np.int64)
    sizes = np.diff(symbols.first)
    full = np.flatnonzero(sizes >= scheme.window)
    inside = np.zeros(len(place) + 1, np.int8)
    inside[symbols.first[full]] += 1
    inside[symbols.first[full] + sizes[full] - scheme.window + 1] -= 1
    inside = np.cumsum(inside[:-1], dtype=np.int8).astype(bool)
    turn = place[1:] != place[:-1]
    first = inside.copy()
    first[1:] &= turn | ~inside[:-1]
    last = inside.copy()
    last[:-1] &= turn | ~inside[1:]
    begin, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    text = np.searchsorted(symbols.first, begin, side="right") - 1
    return Runs(
        text, begin - symbols.first[text], end - begin, grams[place[begin]],
        symbols.hash_of(*symbols.bytes_of(begin, end - 1 + scheme.window)),
    )


def in_order(table: pa.Table) -> tuple[list[int | None], list[bytes | None], list[int]]:
    """Documents of a block by id (null first), equal ids by text, and their rows: the same in every pass."""
    ids, texts = table.column("doc_id").to_pylist(), as_bytes(table.column("text").combine_chunks())
    order = sorted(range(len(ids)), key=lambda i: (ids[i] is not None, ids[i] or 0, texts[i] is not None, texts[i] or b""))
    return [ids[i] for i in order], [texts[i] for i in order], order


def block_runs(texts: list[bytes | None], scheme: Scheme) -> Iterator[tuple[int, Words, Runs]]:
    """Runs of a block, a bounded number of texts at a time, with the number of the first text."""
    for begin, end in pieces(pa.array(texts, pa.large_binary()), PART_BYTES):
        symbols = scheme.symbols(texts[begin:end])
        yield begin, symbols, find_runs(symbols, scheme)


def anchors(scheme: Scheme) -> Callable:
    """Distinct runs of a block as anchor and hash, and whether the run stands twice."""

    def run(table: pa.Table) -> pa.Table:
        _, texts, _ = in_order(table)
        found = [(r.anchor, r.hash) for _, _, r in block_runs(texts, scheme)]
        anchor, hashes = (np.concatenate([f[i] for f in found] or [np.zeros(0, np.uint64)]) for i in range(2))
        order = np.lexsort((hashes, anchor))
        anchor, hashes = anchor[order], hashes[order]
        heads = np.flatnonzero(pair_heads(anchor, hashes))
        counts = np.diff(np.append(heads, len(order)))
        return pa.table({
            "anchor": pa.array(anchor[heads].view(np.int64)),
            "hash": pa.array(hashes[heads].view(np.int64)),
            "block": pa.array(np.full(len(heads), table.column("block")[0].as_py() if len(table) else 0, np.int32)),
            "twice": pa.array(counts > 1),
        })

    return run


def pair_heads(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Where a new pair begins in two sorted columns."""
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return new


_SENT = (
    "shard bigint, part int, anchor bigint, hash bigint, doc_id bigint, block int, ordinal int, begin int, count int, "
    "twice boolean, content binary"
)


def _sent(**columns) -> pa.Table:
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.binary()]
    names = ["shard", "part", "anchor", "hash", "doc_id", "block", "ordinal", "begin", "count", "twice", "content"]
    return pa.table([pa.array(columns[n], t, from_pandas=False) for n, t in zip(names, types, strict=True)], names=names)


def run_key(anchor: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    return anchor ^ mix(hashes)


def send(scheme: Scheme, shards: int) -> Callable:
    """Runs whose anchors occur elsewhere, each with the shard or units that compare it.

    Equal runs of the block are sent once, as the first of them; the windows of the others are known
    to repeat and become spans at once (rows whose content is null).  Content is empty where another
    block sends it, or where all runs of the anchor are equal (``parts`` is 0) and none is needed.
    """

    def run(docs: pa.Table, wanted: pa.Table) -> pa.Table:
        out = []
        ids, texts, _ = in_order(docs)
        block = docs.column("block")[0].as_py() if len(docs) else 0
        known = run_key(*(wanted.column(n).to_numpy().view(np.uint64) for n in ("anchor", "hash")))
        order = np.argsort(known, kind="stable")
        known, parts_of = known[order], wanted.column("parts").to_numpy()[order]
        sends = wanted.column("sends").to_numpy(zero_copy_only=False)[order]
        kept: list[Runs] = []
        content: list[bytes] = []
        at_parts: list[np.ndarray] = []
        for base, symbols, runs in block_runs(texts, scheme) if len(known) else ():
            keys = run_key(runs.anchor, runs.hash)
            at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
            hit = np.flatnonzero(known[at] == keys)
            at_parts.append(parts_of[at[hit]])
            runs = runs.pick(hit)
            first = symbols.first[runs.text] + runs.begin
            begin, end = symbols.bytes_of(first, first + runs.count - 1 + scheme.window)
            own = sends[at[hit]] & (at_parts[-1] > 0)
            content += [
                symbols.whole[a:b] if o else b"" for a, b, o in zip(begin.tolist(), end.tolist(), own.tolist(), strict=True)
            ]
            runs.text = runs.text + base
            kept.append(runs)
        if kept:
            runs = Runs(*(np.concatenate([getattr(k, f) for k in kept]) for f in ("text", "begin", "count", "anchor", "hash")))
            parts = np.concatenate(at_parts)
            order = np.lexsort((np.arange(len(runs.text)), runs.hash, runs.anchor))
            new = pair_heads(runs.anchor[order], runs.hash[order])
            heads = np.flatnonzero(new)
            sizes = np.diff(np.append(heads, len(order)))
            first, twice = order[heads], sizes > 1
            # Spans that are known already, joined where they overlap.
            copies = np.sort(order if scheme.first_too else order[~new])
            if scheme.first_too:
                copies = np.sort(order[np.repeat(twice, sizes)])
            spans = join_spans(runs.text[copies], runs.begin[copies], runs.begin[copies] + runs.count[copies] - 1 + scheme.window)
            n = len(spans[0])
            out.append(_sent(
                shard=np.full(n, block % shards), part=np.zeros(n, np.int32), anchor=np.zeros(n, np.int64), hash=np.zeros(n, np.int64), doc_id=np.zeros(n, np.int64),
                block=np.full(n, block, np.int32), ordinal=spans[0].astype(np.int32), begin=spans[1].astype(np.int32),
                count=(spans[2] - spans[1]).astype(np.int32), twice=np.zeros(n, bool), content=[None] * n,
            ))
            # Each run goes to its anchor's shard, or to all units in which its part meets another.
            split = np.maximum(parts[first], 1)
            row = np.repeat(first, split)
            other = np.arange(len(row)) - np.repeat(np.cumsum(split) - split, split)
            own = (runs.hash[row] % np.maximum(parts[row], 1).astype(np.uint64)).astype(np.int64)
            low, high = np.minimum(own, other), np.maximum(own, other)
            unit = mix(runs.anchor[row] ^ mix((low * (1 << 20) + high + 1).astype(np.uint64)))
            shard = np.where(parts[row] > 1, (unit >> np.uint64(1)).astype(np.int64) | (1 << 62), (runs.anchor[row] % np.uint64(shards)).astype(np.int64))
            at_twice = np.repeat(twice, split)
            out.append(_sent(
                shard=shard, part=(own != low).astype(np.int32), anchor=runs.anchor[row].view(np.int64), hash=runs.hash[row].view(np.int64),
                doc_id=[ids[i] for i in runs.text[row]], block=np.full(len(row), block, np.int32),
                ordinal=runs.text[row].astype(np.int32), begin=runs.begin[row].astype(np.int32), count=runs.count[row].astype(np.int32),
                twice=at_twice, content=[content[i] for i in row.tolist()],
            ))
        return pa.concat_tables(out) if out else _sent(**{n: [] for n in ("shard", "part", "anchor", "hash", "doc_id", "block", "ordinal", "begin", "count", "twice", "content")})

    return run


def join_spans(owner: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Union of spans of each owner; spans that touch become one."""
    order = np.lexsort((begin, owner))
    owner, begin, end = owner[order], begin[order], end[order]
    if not len(order):
        return owner, begin, end
    # Owners far apart on one line, so that one running maximum serves all.
    far = int(end.max()) + 2
    reach = np.maximum.accumulate(end + owner * far)
    new = np.ones(len(order), bool)
    new[1:] = begin[1:] + owner[1:] * far > reach[:-1]
    heads = np.flatnonzero(new)
    lasts = np.append(heads[1:], len(order)) - 1
    return owner[heads], begin[heads], reach[lasts] - owner[heads] * far


@dataclass
class Shard:
    """Different runs of a shard whose anchor has at least two: content, windows, order and part."""

    contents: list[bytes]
    counts: np.ndarray
    #: The place of the run's first occurrence in the order of all occurrences (id, text, place).
    order: np.ndarray
    part: np.ndarray


def compare(scheme: Scheme, repeated: Callable[[Shard], list[np.ndarray]]) -> Callable:
    """Spans found in a shard; ``repeated`` tells for each run which of its windows repeat."""

    def run(table: pa.Table) -> pa.Table:
        columns = {n: table.column(n).combine_chunks() for n in table.column_names}
        block, ordinal, begin, count = (columns[n].to_numpy(zero_copy_only=False).astype(np.int64) for n in ("block", "ordinal", "begin", "count"))
        done = columns["content"].is_null().to_numpy(zero_copy_only=False)
        spans = [(block[done], ordinal[done], begin[done], begin[done] + count[done])]
        rows = np.flatnonzero(~done)
        if len(rows):
            has_id = columns["doc_id"].is_valid().to_numpy(zero_copy_only=False)[rows]
            doc_id = columns["doc_id"].fill_null(0).to_numpy(zero_copy_only=False)[rows]
            anchor = columns["anchor"].to_numpy(zero_copy_only=False)[rows]
            twice = columns["twice"].to_numpy(zero_copy_only=False)[rows]
            part = columns["part"].to_numpy(zero_copy_only=False)[rows]
            b, o, s, c = block[rows], ordinal[rows], begin[rows], count[rows]
            place = np.empty(len(rows), np.int64)
            place[np.lexsort((s, o, b, doc_id, has_id))] = np.arange(len(rows))
            # The first occurrence of each different run stands for it; copies repeat as a whole.
            hashes = columns["hash"].to_numpy(zero_copy_only=False)[rows]
            by = np.lexsort((place, hashes, anchor))
            head = pair_heads(anchor[by], hashes[by])
            which = np.empty(len(rows), np.int64)
            which[by] = np.cumsum(head) - 1
            copies = by[~head]
            sizes = np.bincount(which)
            if scheme.first_too:
                again = np.bincount(which, twice) > 0
                copies = np.flatnonzero((sizes[which] > 1) | again[which])
            spans.append((b[copies], o[copies], s[copies], s[copies] + c[copies] - 1 + scheme.window))
            first = by[head]
            told = np.flatnonzero(pa.compute.binary_length(columns["content"].take(pa.array(rows))).to_numpy(zero_copy_only=False) > 0)
            text_of = np.full(len(sizes), -1)
            text_of[which[told]] = told
            met = np.unique(anchor[first], return_inverse=True, return_counts=True)
            several = np.flatnonzero(met[2][met[1]] > 1)
            if len(several):
                own = first[several]
                content = columns["content"].take(pa.array(rows[text_of[several]])).to_pylist()
                shard = Shard(content, c[own], place[own], part[own])
                flags = repeated(shard)
                text = np.repeat(np.arange(len(own)), [len(f) for f in flags])
                at = np.flatnonzero(np.concatenate(flags))
                starts = np.cumsum(c[own]) - c[own]
                window = at - starts[text[at]]
                found = join_spans(text[at], window, window + scheme.window)
                row = own[found[0]]
                spans.append((b[row], o[row], s[row] + found[1], s[row] + found[2]))
        return pa.table({n: pa.array(np.concatenate([x[i] for x in spans]).astype(np.int32)) for i, n in enumerate(("block", "ordinal", "begin", "end"))})

    return run


def repeated_spans(
    docs: DataFrame, scheme: Scheme, repeated: Callable[[Shard], list[np.ndarray]], *keep: str
) -> tuple[DataFrame, DataFrame]:
    """Documents in blocks (``block, doc_id, text, *keep``) and spans of repeated windows (``block, ordinal, begin, end``).

    ``ordinal`` numbers a block's documents in the order of :func:`in_order`; spans are counted in
    symbols and may overlap.
    """
    reach_workers(docs.sparkSession)
    rows = id_and_text(docs, *keep)
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks, shards = max(1, -(-total // BLOCK_BYTES)), max(1, -(-total // SHARD_BYTES))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int"))
    by_block = dealt.groupBy("block")
    found = by_block.applyInArrow(anchors(scheme), "anchor bigint, hash bigint, block int, twice boolean")
    everywhere, equal = Window.partitionBy("anchor"), Window.partitionBy("anchor", "hash")
    different = F.sum(F.col("sends").cast("int")).over(everywhere)
    wanted = (
        found.withColumn("sends", F.col("block") == F.min("block").over(equal))
        .withColumn("places", F.count("*").over(everywhere))
        .withColumn("repeats", F.max("twice").over(everywhere))
        .withColumn("parts", F.when(different == 1, 0).otherwise(F.ceil(different / PART_RUNS)).cast("int"))
        .where((F.col("places") > 1) | F.col("repeats"))
        .select("anchor", "hash", "block", "parts", "sends")
    )
    sent = by_block.cogroup(wanted.groupBy("block")).applyInArrow(send(scheme, shards), _SENT)
    spans = sent.groupBy("shard").applyInArrow(compare(scheme, repeated), "block int, ordinal int, begin int, end int")
    return dealt, spans


def per_document(dealt: DataFrame, spans: DataFrame, make: Callable, schema: str) -> DataFrame:
    """``doc_id``, the columns kept with ``dealt``, and what ``make(texts, spans)`` gives for each block.

    ``spans`` are the documents' joined spans, (begins, ends) for each; ``make`` returns one list per
    column of ``schema``.
    """
    keep = [f for f in dealt.schema if f.name not in ("text", "block")]
    out = StructType([*keep, *StructType.fromDDL(schema)])

    def run(docs: pa.Table, found: pa.Table) -> pa.Table:
        from pyspark.sql.pandas.types import to_arrow_schema

        ids, texts, rows = in_order(docs)
        ordinal, begin, end = join_spans(*(found.column(n).to_numpy().astype(np.int64) for n in ("ordinal", "begin", "end")))
        cuts = np.searchsorted(ordinal, np.arange(len(ids) + 1))
        made = make(texts, [(begin[a:b], end[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)])
        arrow = to_arrow_schema(out)
        kept = docs.select([f.name for f in keep]).take(pa.array(rows, pa.int64())).cast(pa.schema(list(arrow)[: len(keep)]))
        columns = [*kept.columns, *[pa.array(c, arrow.field(len(keep) + i).type) for i, c in enumerate(made)]]
        return pa.table(columns, schema=arrow)

    return dealt.groupBy("block").cogroup(spans.groupBy("block")).applyInArrow(run, out)
