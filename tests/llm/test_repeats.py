"""Repeated words and bytes against counting every window."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
from fixtures import empty, rows, table, words_of
from hypothesis import given, settings
from hypothesis import strategies as st

from tripmeter.llm import contamination, quality, repeats, substrings, suffix_dedup
from tripmeter.llm.repeats import Bytes, Scheme, SingleSpaced, find_runs, join_spans
from tripmeter.llm.suffixes import common_prefixes, merge, suffix_array
from tripmeter.llm import words as words_module
from tripmeter.llm.words import Words, windows


def cover(n, starts, size):
    flags = [False] * n
    for s in starts:
        flags[s:s + size] = [True] * size
    return flags


def expected_words(texts, size):
    words = [words_of(t) for t in texts]
    seen = Counter(tuple(w[i:i + size]) for w in words for i in range(len(w) - size + 1))
    out = []
    for w in words:
        gone = cover(len(w), [i for i in range(len(w) - size + 1) if seen[tuple(w[i:i + size])] > 1], size)
        out.append((len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g)))
    return out


def expected_bytes(ordered, size):
    seen, out = set(), []
    for text in ordered:
        raw = (text or "").encode()
        late = []
        for i in range(len(raw) - size + 1):
            if raw[i:i + size] in seen:
                late.append(i)
            seen.add(raw[i:i + size])
        gone = cover(len(raw), late, size)
        out.append((len(raw), sum(gone), bytes(x for x, g in zip(raw, gone, strict=True) if not g)))
    return out


@pytest.mark.parametrize("window,gram", [(35, 6), (9, 3)])
def test_words(spark, window, gram):
    data = rows()
    want = sorted((str(r[0]), *w) for r, w in zip(data, expected_words([r[1] for r in data], window), strict=True))
    got = substrings.deduplicated(table(spark), window, gram).collect()
    assert sorted((str(r.doc_id), r.n_words, sum(s.end - s.begin for s in r.spans), r.kept) for r in got) == want


@pytest.mark.parametrize("window", [100, 40])
def test_bytes(spark, window):
    # Ids that repeat with different texts are ordered by a hash of the text, so leave those out here.
    data = [r for r in rows() if r[0] is not None and not str(r[1]).startswith("another")]
    data.sort(key=lambda r: r[0])
    want = sorted((r[0], *w) for r, w in zip(data, expected_bytes([r[1] for r in data], window), strict=True))
    from fixtures import SCHEMA

    docs = spark.createDataFrame(data, SCHEMA).repartition(4)
    got = suffix_dedup.deduplicated(docs, window, 32).collect()
    assert sorted((r.doc_id, r.n_bytes, sum(s.end - s.begin for s in r.spans), bytes(r.kept)) for r in got) == want


def test_split_anchors_give_the_same(spark, monkeypatch):
    """Anchors cut into parts whose units meet, several blocks and shards."""
    docs = table(spark, n=120)
    whole = [sorted((str(r.doc_id), bytes(r.kept)) for r in suffix_dedup.deduplicated(docs, 100, 32).collect())]
    whole.append(sorted((str(r.doc_id), r.kept) for r in substrings.deduplicated(docs).collect()))
    for name, value in (("BLOCK_BYTES", 4000), ("SHARD_BYTES", 3000), ("PART_RUNS", 2)):
        monkeypatch.setattr(repeats, name, value)
    assert whole[0] == sorted((str(r.doc_id), bytes(r.kept)) for r in suffix_dedup.deduplicated(docs, 100, 32).collect())
    assert whole[1] == sorted((str(r.doc_id), r.kept) for r in substrings.deduplicated(docs).collect())


def test_readable_text_loses_only_what_stands_at_a_cut(spark):
    import corpus_pipeline

    # The second text shares 149 bytes and the first two of a character's three.
    shared = "".join(random.Random(6).choices("abcdefghijklmnop", k=149))
    data = [(1, shared + "\u3042 one", "en", "s", 153), (2, "own \ufffd text " + shared + "\u3044 rest \ufffd", "en", "s", 169)]
    docs = spark.createDataFrame(data, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    raw = {r.doc_id: bytes(r.kept) for r in suffix_dedup.deduplicated(docs).collect()}
    assert raw[2] == "own \ufffd text ".encode() + "\u3044".encode()[2:] + " rest \ufffd".encode()
    got = {r.doc_id: (r.text, r.n_chars) for r in corpus_pipeline.cut_repeats(spark, docs, "").collect()}
    want = "own \ufffd text  rest \ufffd"
    assert got == {1: (data[0][1], 153), 2: (want, len(want))}


def test_empty_table(spark):
    assert substrings.deduplicated(empty(spark)).count() == 0
    assert suffix_dedup.deduplicated(empty(spark)).count() == 0


def test_text_crosses_the_network_once(spark):
    docs = table(spark)
    frame = suffix_dedup.deduplicated(docs)
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ReusedExchange") >= 1 or plan.count("ReusedQueryStage") >= 1


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=80))
def test_suffix_array(values):
    data = np.array(values, np.int64)
    order, rank = suffix_array(data, 1)
    assert order.tolist() == sorted(range(len(values)), key=lambda i: values[i:])
    assert (order[rank] == np.arange(len(values))).all()
    prefixes = common_prefixes(data, order, np.array([0]), np.array([len(values)]), 1000)
    for a, b in zip(order[:-1], order[1:], strict=True):
        n = next((k for k in range(len(values)) if a + k >= len(values) or b + k >= len(values) or values[a + k] != values[b + k]), 0)
        assert prefixes[b] == n


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text("ab \n", max_size=60), max_size=6), st.integers(3, 9))
def test_runs_cover_all_windows_once(texts, window):
    raw = [t.encode() for t in texts]
    for symbols, gram, sizes in ((SingleSpaced, 2, [len(t.split()) for t in raw]),):
        runs = find_runs(symbols(raw), Scheme(symbols, window, gram, True))
        found = sorted((t, b + i) for t, b, c in zip(runs.text.tolist(), runs.begin.tolist(), runs.count.tolist(), strict=True) for i in range(c))
        assert found == [(t, i) for t, n in enumerate(sizes) for i in range(n - window + 1)]


def test_equal_windows_share_anchors():
    rng = np.random.default_rng(1)
    shared = bytes(rng.integers(97, 123, 160).astype(np.uint8))
    texts = [bytes(rng.integers(97, 123, 300).astype(np.uint8)) + shared + b"1" * k for k in range(5)]
    runs = find_runs(Bytes(texts), Scheme(Bytes, 100, 32, False))
    per_text = [set(runs.anchor[runs.text == t].tolist()) for t in range(5)]
    assert set.intersection(*per_text)


def test_spans_join():
    owner, begin, end = join_spans(np.array([1, 0, 0, 0]), np.array([5, 3, 0, 9]), np.array([8, 6, 3, 10]))
    assert list(zip(owner.tolist(), begin.tolist(), end.tolist(), strict=True)) == [(0, 0, 6), (0, 9, 10), (1, 5, 8)]


def test_merge_finds_equal_strings():
    a, b = merge(np.array([b"aa", b"bb", b"dd"]), np.array([b"ab", b"bb", b"dd", b"zz"]))
    assert a.tolist() == [1, 2] and b.tolist() == [1, 2]


def test_hashes_tell_words_and_windows_apart():
    texts = [t.encode() for t in ("a b a b c", "", "ab ba  ab\nx", "c")]
    words = Words(texts)
    raw = [words.whole[a:b] for a, b in zip(words.starts, words.ends, strict=True)]
    assert raw == [w for t in texts for w in t.split()] and words.counts.tolist() == [5, 0, 4, 1]
    hashes = words.hashes()
    assert len(set(hashes.tolist())) == len(set(raw))
    assert len(windows(hashes, 11)) == 0 and len(windows(hashes, 10)) == 1


def exchanged(doublings=10):
    """Two different words that a polynomial modulo a power of two cannot tell apart."""
    a, b = "a", "b"
    for _ in range(doublings):
        a, b = a + b, b + a
    return a, b


def test_words_by_doubling_and_exchange(spark):
    one, other = exchanged()
    rest = " ".join(f"w{i}" for i in range(34))
    rows = [(1, f"{rest} {one}"), (2, f"{rest} {other}"), (3, f"{one} " * 40)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: sum(s["end"] - s["begin"] for s in r.spans) for r in substrings.deduplicated(docs).collect()}
    assert got == {1: 0, 2: 0, 3: 40}


def test_the_same_words_in_items_and_windows(spark, path):
    one, other = exchanged()
    docs = spark.createDataFrame([(1, f"x {one} y"), (2, f"x {other} y")], "doc_id bigint, text string")
    items = spark.createDataFrame([("i", one)], "item_id string, text string")
    got = {r.doc_id: (r.n_hit, r.items) for r in contamination.contamination(docs, items, f"{path}/c").collect()}
    assert got == {1: (1, ["i"]), 2: (0, [])}
    seven = " ".join("abcdefg")
    pair = spark.createDataFrame([(1, f"{seven} {one} {seven} {other}", "en", "s")], "doc_id bigint, text string, lang string, source string")
    assert quality.quality(pair, f"{path}/q").first().n_repeat_words == 0


def test_hashes_of_byte_ranges():
    data = bytes(range(256)) * 50
    words = Words([data, data[7:900]])
    starts = np.arange(0, 3000, 7)
    assert (words.hash_of(starts, starts + 40) == words.hash_of(starts + 256, starts + 296)).all()
    exact = [sum((c + 1) * pow(words_module._RATIO, i, words_module.PRIME) for i, c in enumerate(data[:k])) % words_module.PRIME for k in (1, 2, 700, 12000)]
    assert words_module.prefix_sums(np.frombuffer(data, np.uint8))[[1, 2, 700, 12000]].tolist() == exact


def test_places_beyond_the_packed_bits(monkeypatch):
    monkeypatch.setattr(repeats, "_PLACE_BITS", np.uint64(8))
    text = random.Random(1).randbytes(3000)
    scheme = Scheme(Bytes, 100, 40, first_too=False)
    symbols = repeats.Bytes([text])
    few = repeats.find_runs(symbols, scheme)
    assert few.count.sum() == len(text) - scheme.window + 1
    assert (few.begin[1:] == few.begin[:-1] + few.count[:-1]).all()
    grams = symbols.grams(scheme.gram)
    reach = scheme.window - scheme.gram + 1
    assert all(a in grams[b:b + c + reach] for a, b, c in zip(few.anchor, few.begin, few.count, strict=True))
