"""Exact duplicates against a dictionary of texts, with small buckets and colliding hashes."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import pytest
from fixtures import SCHEMA, empty, rows, table

from tripmeter.llm import exact

WHITE = re.compile(r"[\x20\x09-\x0D]")


def plain(text):
    return WHITE.sub("", text or "")


def expected(data):
    """(doc_id, keep_id, group_size, sha256) of every row, and how many rows each group keeps: one."""
    groups = defaultdict(list)
    for doc_id, text in data:
        groups[plain(text)].append((-len(text or ""), doc_id is None, doc_id or 0, doc_id))
    out = []
    for doc_id, text in data:
        own = groups[plain(text)]
        out.append((doc_id, min(own)[3], len(own), hashlib.sha256(plain(text).encode()).hexdigest()))
    return out


def order(rows_):
    return sorted(rows_, key=repr)


def check(found, data):
    got = found.collect()
    assert order((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == order(expected(data))
    stays = [r for r in got if r.kept]
    assert len(stays) == len({plain(t) for _, t in data})
    assert all(r.doc_id == r.keep_id for r in stays)
    assert len({r.text_sha256 for r in stays}) == len(stays)


@pytest.mark.parametrize(("bucket_bytes", "hash_bits"), [(1 << 23, 64), (4000, 64), (3000, 3)])
def test_groups(spark, path, bucket_bytes, hash_bits):
    data = [r[:2] for r in rows()]
    data += [(1000 + i, ["same text", "same\ttext ", " sametext"][i % 3]) for i in range(90)]
    data += [(2000 + i, f"text {i % 7}") for i in range(60)]
    docs = spark.createDataFrame(data, "doc_id bigint, text string").repartition(6)
    check(exact.exact_duplicates(docs, path, bucket_bytes=bucket_bytes, hash_bits=hash_bits), data)


def test_directory_splits_what_is_full(spark, path):
    data = [(i, f"a text of its own {i} " + "long" * (200 if i % 9 == 0 else 0)) for i in range(400)]
    staged = exact.stage_rows(spark.createDataFrame(data, "doc_id bigint, text string"), f"{path}/rows")
    entries = staged.where("content IS NOT NULL")
    directory = exact.build_directory(entries, f"{path}/directory", 2000)
    sizes = exact.routed(entries, directory).groupBy("depth", "bits").sum("size").collect()
    assert sum(r["sum(size)"] for r in sizes) == sum(len(plain(t)) + exact.ENTRY_BYTES for _, t in data)
    assert max(r["sum(size)"] for r in sizes) <= 2000
    assert {r.depth for r in sizes} <= {directory[0] + i for i in range(len(directory[1]) + 1)}
    assert len(directory[1]) > 0


def test_collisions_are_chained(spark, path):
    data = [(i, f"text {i % 5}") for i in range(20)]
    docs = spark.createDataFrame(data, "doc_id bigint, text string").repartition(4)
    check(exact.exact_duplicates(docs, path, hash_bits=0), data)
    chains = spark.read.parquet(f"{path}/index/chains-0")
    assert chains.agg({"place": "max"}).first()[0] == 4


def test_hot_text_takes_rounds(spark, path):
    """Every task sends the text once; the copies meet in parts, and what stays of the parts meets again."""
    data = [(i, "hot " * 30) for i in range(64)] + [(100 + i, f"cold {i}") for i in range(30)]
    docs = spark.createDataFrame(data, "doc_id bigint, text string").repartition(48)
    check(exact.exact_duplicates(docs, path, bucket_bytes=600), data)
    spark.read.parquet(f"{path}/index/chains-1")


def test_columns_of_the_caller(spark, path):
    docs = table(spark)
    found = exact.exact_duplicates(docs, path, "lang", "key", "fp", "block")
    assert found.columns == ["row", "doc_id", "lang", "key", "fp", "block", "keep_id", "group_size", "kept", "text_sha256"]
    assert found.where("key = 'k' AND fp = 'f'").count() == len(rows()) - 1
    clashing = docs.selectExpr("doc_id", "text", "'x' AS row", "'x' AS ref", "'x' AS hash", "'x' AS size", "'x' AS content", "'x' AS kept", "'x' AS keep_id", "'x' AS depth")
    check(exact.exact_duplicates(clashing, f"{path}/again"), [r[:2] for r in rows()])


def test_long_and_empty(spark, path):
    data = [(1, "é " * 2_500_000), (2, "é" * 2_500_000), (3, None), (4, " \n"), (None, "")]
    check(exact.exact_duplicates(spark.createDataFrame(data, "doc_id bigint, text string"), path), data)
    assert exact.exact_duplicates(empty(spark), f"{path}/empty").count() == 0
    assert "text" in SCHEMA
