"""The stages one by one and in a row, against plain computations."""

from __future__ import annotations

import re
from collections import Counter

import pytest
from fixtures import plain_words, rows, words_of
from test_contamination import expected as contaminated_words
from test_repeats import expected_bytes
from test_scoring import goals
from test_simhash import components, fingerprint

import corpus_pipeline as pipeline
from tripmeter.llm import language

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Documents with nulls, copies and repeated rows, and a benchmark taken from one of them."""
    path = str(tmp_path_factory.mktemp("sf"))
    data = [r[:5] for r in rows(n=50)]
    items = [(1, " ".join(plain_words(data[7][1])[:30])), (2, None), (3, "ab")]
    spark.createDataFrame(data, COLUMNS).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, data, [(str(i), t) for i, t in items]


def table(spark, data):
    return spark.createDataFrame(data, COLUMNS).repartition(3)


def test_language_drops_texts_without_letters(spark, folder):
    path, data, _ = folder
    got = pipeline.identify_language(spark, table(spark, data), path)
    assert got.columns == list(pipeline.COLUMNS)
    want = sorted(str(r[0]) for r in data if any(c.isalpha() for c in r[1] or ""))
    kept = [str(r.doc_id) for r in got.collect()]
    assert not Counter(kept) - Counter(want) and len(kept) >= 0.95 * len(want)
    assert got.where("lang IS NULL").count() == 0


def test_one_document_of_each_group(spark, folder):
    path, data, _ = folder
    got = pipeline.drop_near_duplicates(spark, table(spark, data), path).collect()
    pairs = [(r[0], fingerprint(r[1])) for r in data]
    assert sorted(str(r.doc_id) for r in got) == sorted(str(c) for c, _ in set(components(pairs)))


def test_repeats_are_cut(spark, folder):
    path, data, _ = folder
    once = sorted({r[0]: r for r in data if r[0] is not None}.values())
    got = {r.doc_id: r for r in pipeline.cut_repeats(spark, table(spark, once), path).collect()}
    for row, (_, gone, kept) in zip(once, expected_bytes([r[1] for r in once], 100), strict=True):
        assert got[row[0]].text == kept.decode("utf-8", "ignore")
        assert got[row[0]].n_chars == (len(got[row[0]].text) if gone else row[4])
        assert (got[row[0]].lang, got[row[0]].source) == row[2:4]


def test_contaminated_documents_go(spark, folder):
    path, data, items = folder
    got = Counter(str(r.doc_id) for r in pipeline.drop_contaminated(spark, table(spark, data), path).collect())
    want = Counter(i for i, n, hit, _ in contaminated_words(data, items) if not (hit and 20 * hit >= n))
    assert got == want and sum(want.values()) < len(data)


def test_mix_takes_the_targets(spark, folder):
    path, data, _ = folder
    got = pipeline.mix_sources(spark, table(spark, data), path).collect()
    sizes = Counter()
    for r in data:
        sizes[r[3]] += len(words_of(r[1]))
    taken = Counter()
    for r in got:
        assert 0 < r.taken <= 2 * r.size and r.size == len(words_of(r.text))
        taken[r.source] += r.taken
    want = goals(dict(sizes))
    assert all(abs(taken[s] - want[s]) <= 1 for s in sizes)


def test_run_and_an_empty_table(spark, folder, tmp_path):
    path, data, _ = folder
    got = pipeline.run(spark, path)
    assert 0 < got.count() < len(data)
    spark.createDataFrame([], COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{path}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert pipeline.run(spark, str(tmp_path)).count() == 0


def test_letters():
    assert language.has_letter("1 é") and language.has_letter("中")
    assert not any(map(language.has_letter, ["", "½ ² ①", "12_3 !", "́"]))


def test_near_duplicates_broadcast_no_cells(spark, folder, tmp_path, monkeypatch):
    """Documents below the broadcast threshold have many more grid cells, which are not broadcast."""
    path, data, _ = folder
    table(spark, data).write.parquet(f"{tmp_path}/documents.parquet")
    frame, plans = type(spark.range(0)), []
    run = frame.mapInArrow

    def seen(self, *args, **more):
        plans.append(self._jdf.queryExecution().executedPlan().toString())
        return run(self, *args, **more)

    monkeypatch.setattr(frame, "mapInArrow", seen)
    pipeline.drop_near_duplicates(spark, spark.read.parquet(f"{tmp_path}/documents.parquet"), path)
    joined = [p for p in plans if "Join" in p]
    assert joined and not any("Broadcast" in p for p in joined)
