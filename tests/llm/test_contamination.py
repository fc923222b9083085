"""Benchmark text against looking at every window."""

from __future__ import annotations

from fixtures import empty, plain_words, rows, table
from pyspark.sql import functions as F

from tripmeter.llm import contamination
from tripmeter.session import scratch_path


def benchmark(spark):
    data = rows()
    long = " ".join(plain_words(data[0][1])[-40:])
    items = [("b1", long.upper()), ("b2", "x"), (None, "only nowhere found"), ("b3", None), ("b4", ""), ("b1", "ab ab ab"), ("b5", data[7][1]), ("b5", data[7][1])]
    return items, spark.createDataFrame(items, "item_id string, text string")


def expected(data, items, size=13):
    out = []
    windows = {}
    for item, text in items:
        words = plain_words(text)
        n = min(size, len(words))
        for i in range(len(words) - n + 1 if n else 0):
            windows.setdefault((n, tuple(words[i:i + n])), set()).add(item or "")
    sizes = {n for n, _ in windows}
    for row in data:
        words = plain_words(row[1])
        hit, found = set(), set()
        for n in sizes:
            for i in range(len(words) - n + 1):
                names = windows.get((n, tuple(words[i:i + n])))
                if names:
                    hit.update(range(i, i + n))
                    found |= names
        out.append((str(row[0]), len(words), len(hit), sorted(found)))
    return sorted(out)


def test_against_every_window(spark):
    data, (items, frame) = rows(), benchmark(spark)
    got = contamination.contamination(table(spark), frame, scratch_path(spark, "c")).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_hit, r["items"]) for r in got) == expected(data, items)


def test_segments_and_blocks_do_not_matter(spark, monkeypatch):
    items, frame = benchmark(spark)
    monkeypatch.setattr(contamination, "SEGMENT_BYTES", 500)
    monkeypatch.setattr(contamination, "BLOCK_WORDS", 20)
    got = contamination.contamination(table(spark), frame, scratch_path(spark, "c")).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_hit, r["items"]) for r in got) == expected(rows(), items)


def test_empty_tables(spark):
    _, frame = benchmark(spark)
    assert contamination.contamination(empty(spark), frame, scratch_path(spark, "c")).count() == 0
    nothing = spark.createDataFrame([], "item_id string, text string")
    got = contamination.contamination(table(spark), nothing, scratch_path(spark, "c"))
    assert got.where("n_hit > 0 OR size(items) > 0").count() == 0 and got.count() == len(rows())


def test_phrases_and_proximity(spark):
    docs = spark.createDataFrame([(1, "one two three four five six seven"), (2, "seven x x x x x six"), (3, "six seven"), (4, "six")], "doc_id bigint, text string")
    items = spark.createDataFrame([("q", "seven six")], "item_id string, text string")
    index = contamination.build_index(docs, scratch_path(spark, "i"))
    where = contamination.indexed_documents(index)
    near = contamination.proximity_matches(index, items, 2).join(where, ["segment", "ordinal"])
    assert sorted(r.doc_id for r in near.collect()) == [1, 3]
    phrase = contamination.phrase_matches(index, spark.createDataFrame([("q", "three four FIVE")], "item_id string, text string"))
    found = phrase.join(where, ["segment", "ordinal"]).collect()
    assert [(r.doc_id, r.start, r["size"], r.item_start) for r in found] == [(1, 2, 3, 0)]


def test_rule_keeps_clean_documents(spark):
    _, frame = benchmark(spark)
    docs = table(spark)
    kept = contamination.without_contaminated(docs, frame, scratch_path(spark, "c"))
    verdict = contamination.contamination(docs, frame, scratch_path(spark, "c"))
    assert kept.count() == verdict.where(~contamination.contaminated()).count()
    assert kept.columns == docs.columns
    assert verdict.where(F.col("n_hit") > 0).count() > 0


def test_columns_with_the_names_that_are_used_inside(spark):
    docs = table(spark).selectExpr("doc_id", "text", *[f"'mine' AS `{c}`" for c in ("_id", "_HASH", "segment", "ordinal", "n_hit", "items", "part")])
    items = spark.createDataFrame([("i", rows()[5][1])], "item_id string, text string")
    kept = contamination.without_contaminated(docs, items, scratch_path(spark, "c"))
    plain = contamination.without_contaminated(table(spark), items, scratch_path(spark, "c"))
    assert kept.columns == docs.columns
    assert kept.where("`_id` = 'mine' AND `_HASH` = 'mine'").count() == plain.count() < docs.count()
