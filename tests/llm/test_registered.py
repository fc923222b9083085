"""The registered queries on the given tables: columns, types and a brute-force digest."""

from __future__ import annotations

import hashlib
import re

import pytest
from fixtures import words_of
from test_repeats import cover, expected_words

from tripmeter.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
COLUMNS = {
    "op1": {"doc_id": "bigint", "n_words": "bigint", "n_removed": "bigint", "kept_sha256": "string"},
    "op2": {"doc_id": "bigint", "n_bytes": "bigint", "n_removed": "bigint", "n_spans": "bigint", "kept_sha256": "string"},
    "op3": {"doc_id": "bigint", "n_words": "bigint", "n_hit": "bigint", "n_items": "bigint", "items_sha256": "string", "contaminated": "boolean"},
    "op4": {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint"},
    "op5": {"doc_id": "bigint", "n_words": "bigint", "word_chars": "bigint", "n_symbols": "bigint", "n_dup_lines": "bigint", "n_repeat_words": "bigint", "base_failed": "boolean", "kept": "boolean"},
    "op6": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op7": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op8": {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"},
    "op9": {"doc_id": "bigint", "n_words": "bigint", "n_base": "bigint", "first_word": "bigint", "last_word": "bigint", "base_labels": "string", "labels": "string", "score": "double"},
    "op10": {"doc_id": "bigint", "n_bytes": "bigint", "n_tokens": "bigint", "over_limit": "boolean"},
    "op11": {"anchor_id": "bigint", "positive_id": "bigint", "rank": "int", "negative_id": "bigint", "positive_score": "bigint", "negative_score": "bigint"},
    "op12": {"doc_id": "bigint", "keep_id": "bigint", "group_size": "bigint", "kept": "boolean", "text_sha256": "string"},
    "op13": {"conv_id": "bigint", "depth": "bigint", "parent_conv_id": "bigint", "n_convs": "bigint", "n_children": "bigint", "n_leaves": "bigint", "saved_tokens": "bigint", "ends_sha256": "string"},
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_columns_and_rows(spark, name):
    got = QUERIES[name](spark, FOLDER)
    assert COLUMNS[name.split("_")[0]].items() <= dict(got.dtypes).items()
    if "doc_id" not in got.columns:
        return
    ids = [r.doc_id for r in got.select("doc_id").collect()]
    assert sorted(ids) == sorted(r.doc_id for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id").collect())


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet").orderBy("doc_id").collect()


def test_words_digest(spark, documents):
    want = {
        d.doc_id: (n, gone, hashlib.sha256(kept.encode()).hexdigest())
        for d, (n, gone, kept) in zip(documents, expected_words([d.text for d in documents], 35), strict=True)
    }
    got = QUERIES["op1_substring_dedup"](spark, FOLDER).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in got} == want
    assert sum(len(words_of(d.text)) for d in documents) == sum(r.n_words for r in got)


def test_bytes_digest(spark, documents):
    seen, want = set(), {}
    for d in documents:
        raw = d.text.encode()
        late = []
        for i in range(len(raw) - 99):
            if raw[i:i + 100] in seen:
                late.append(i)
            seen.add(raw[i:i + 100])
        gone = cover(len(raw), late, 100)
        kept = bytes(x for x, g in zip(raw, gone, strict=True) if not g)
        spans = len(re.findall("1+", "".join("01"[g] for g in gone)))
        want[d.doc_id] = (len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    got = QUERIES["op2_suffix_dedup"](spark, FOLDER).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == want
