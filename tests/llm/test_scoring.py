"""Quality, toxicity, language, licences, tokens and mixing, each against a plain computation."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest
from fixtures import empty, plain_words, rows, table, texts, words_of
from pyspark.sql import functions as F

from tripmeter.llm import language, licenses, mixing, quality, tokens, toxicity
from tripmeter.session import scratch_path

# Quality ---------------------------------------------------------------------------------------


def counts_of(text):
    words, seen = words_of(text), Counter()
    for i in range(len(words) - 7):
        seen[tuple(words[i:i + 8])] += 1
    covered = {i + j for i in range(len(words) - 7) if seen[tuple(words[i:i + 8])] > 1 for j in range(8)}
    lines = [x for x in (text or "").split("\n") if words_of(x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def test_quality_counts(spark):
    got = quality.quality(table(spark), scratch_path(spark, "q")).collect()
    assert sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == sorted(
        (str(r[0]), *counts_of(r[1])) for r in rows()
    )
    assert all(r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words) for r in got)
    assert not any(r.kept and r.base_failed for r in got)
    assert quality.quality(empty(spark), scratch_path(spark, "q")).count() == 0


def test_limits_adapt_to_each_group(spark):
    rng = random.Random(1)
    data = [("en", "a", rng.gauss(5, 0.2)) for _ in range(400)] + [("de", "a", rng.gauss(9, 0.2)) for _ in range(400)] + [("en", "a", 30.0)] * 20
    frame = spark.createDataFrame(data, "lang string, source string, word_length double")
    found = {r.lang: r.limit_word_length for r in quality.limits(quality.sketch(frame, ["lang", "source"], ["word_length"]), {"word_length": 0.0}).collect()}
    assert 5.3 < found["en"] < 8 < 9.3 < found["de"] < 12


def test_small_groups_take_wider_limits(spark):
    data = [("en", "a", 5.0 + i % 10 / 50) for i in range(300)] + [("en", "b", 40.0)] * 30 + [("xx", "b", 90.0)] * 20 + [(None, None, 0.0)] * 400
    frame = spark.createDataFrame(data, "lang string, source string, word_length double")
    sketched = quality.sketch(frame, ["lang", "source"], ["word_length"])
    found = {(r.lang, r.source): r.limit_word_length for r in quality.limits(sketched, {"word_length": 7.5}).collect()}
    assert 5.2 < found["en", "a"] < 6.5 and found["en", "b"] == pytest.approx(found["en", "a"], abs=1.5)
    # Most of all values are 0, and of the group without a language all: no limit from the data.
    assert found[None, None] == 7.5 and found["xx", "b"] > 5


def test_limits_of_the_given_table_differ_and_decide(spark, path):
    judged = quality.quality(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"), path).where("NOT base_failed").cache()
    seen = [r[0] for r in judged.select("limit_word_length").distinct().collect()]
    assert len(seen) > 3 and max(seen) < quality.RARE["word_length"]
    fixed = " AND ".join(f"{m} <= {most}" for m, most in quality.RARE.items())
    assert judged.where(f"kept <> ({fixed})").count() > 0
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    good, bad = (judged.join(labels.where(f"quality = {q}"), "doc_id").agg(F.avg(F.col("kept").cast("int"))).first()[0] for q in (1, 0))
    assert good > 0.995 and bad < 0.1


def test_sketch_quantiles_are_close_and_merge(spark):
    rng = np.random.default_rng(4)
    values = rng.lognormal(2, 1, 3000)
    frame = spark.createDataFrame([("g", float(v)) for v in values], "g string, x double")
    whole = quality.sketch(frame, ["g"], ["x"])
    halves = quality.sketch(frame.where("x < 7"), ["g"], ["x"]).unionByName(quality.sketch(frame.where("x >= 7"), ["g"], ["x"]))
    merged = halves.groupBy("g", "metric", "bucket").agg(F.sum("n").alias("n"))
    for part in (whole, merged):
        row = quality.quantiles(part, ["g"], [0.5, 0.9]).first()
        for got, share in ((row.q0, 0.5), (row.q1, 0.9)):
            exact = np.quantile(values, share, method="inverted_cdf")
            assert exact <= got * 1.0001 and got <= exact * quality.GROWTH * 1.0001


# Toxicity --------------------------------------------------------------------------------------


def toxic_tables(spark, n=900):
    rng = random.Random(5)
    clean = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 6))) for _ in range(300)]
    bad = ["zorgul", "vexnak", "qwumpf", "trolsk", "zorgast"]
    docs, labels = [], []
    for i in range(n):
        words = rng.choices(clean, k=rng.randint(5, 80))
        toxic = int(rng.random() < 0.2)
        for _ in range(rng.randint(1, 4) * toxic):
            words.insert(rng.randrange(len(words)), rng.choice(bad).upper())
        docs.append((i, " ".join(words), "en", "s", 0))
        labels.append((i, 1, toxic))
    docs += [(n, None, "en", "s", 0), (n + 1, "", "en", "s", 0), (None, "zorgul vexnak", "en", "s", 0)]
    labels += [(None, None, 1), (3, 1, None), (5, 1, labels[5][2])]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string, score bigint").repartition(4)
    return frame, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"), {i: t for i, _, t in labels[:n]}


def test_toxicity_on_held_out_rows(spark):
    docs, labels, truth = toxic_tables(spark)
    model = toxicity.train(docs, labels, language.remainder(4) != 2)
    got = toxicity.toxicity(docs, model).withColumn("held", language.remainder(4) == 2).collect()
    assert len(got) == 903 and all(0 <= r.score <= 1 for r in got)
    held = [(r.score >= 0.3, truth[r.doc_id]) for r in got if r.held and r.doc_id in truth]
    assert sum(p == bool(t) for p, t in held) / len(held) > 0.97
    again = toxicity.train(docs.repartition(7), labels, language.remainder(4) != 2)
    assert np.allclose(model.weights, again.weights)


def test_training_sample_has_two_thousand_toxic_and_three_thousand_clean_rows(spark, monkeypatch):
    rows = [(i, f"zorgul w{i % 50}" if i < 2600 else f"w{i % 50} w{i % 70}", int(i < 2600)) for i in range(6600)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string").repartition(4)
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id bigint, toxic int")
    seen, own = [], toxicity.training_rows
    monkeypatch.setattr(toxicity, "training_rows", lambda *a: seen.append(own(*a)) or seen[-1])
    toxicity.train(docs, labels, F.lit(True))
    marks = seen[0].marks
    assert abs(marks.sum() - 2000) < 120 and abs((1 - marks).sum() - 3000) < 150


def test_label_model_finds_accuracies_and_copies():
    rng = np.random.default_rng(0)
    truth = rng.random(4000) < 0.2
    votes = np.stack([(truth & (rng.random(4000) < h)) | (~truth & (rng.random(4000) < s)) for h, s in ((0.7, 0.01), (0.5, 0.02), (0.4, 0.005))], 1)
    votes = np.concatenate([votes, votes[:, :1], votes.sum(1, keepdims=True) == 0], axis=1).astype(float)
    model = toxicity.LabelModel.fit(votes, 4, 0.2, np.ones(4000))
    assert abs(model.hit[0] - 0.7) < 0.15 and model.slip[0] < 0.05
    assert model.correlations[0, 3] > 0.9 and model.weight[0] < 0.7 < model.weight[2]


def test_without_labels_nothing_is_toxic(spark):
    docs, labels, _ = toxic_tables(spark, 30)
    for some in (labels.limit(0), labels.where("toxic = 0")):
        model = toxicity.train(docs, some, F.lit(True))
        assert toxicity.toxicity(docs, model).agg(F.max("score")).first()[0] < 0.01
    assert toxicity.toxicity(empty(spark), model).count() == 0


# Language --------------------------------------------------------------------------------------


def language_table(spark):
    rng = random.Random(8)
    stems = {"aa": ["the", "ing", "er", "th"], "bb": ["ción", "os", "ue", "ll"], "cc": ["sch", "ung", "ei", "ß"]}
    docs = []
    for i in range(300):
        lang = rng.choice(sorted(stems))
        text = " ".join("".join(rng.choices(stems[lang], k=rng.randint(1, 4))) for _ in range(rng.randint(3, 120)))
        docs.append((i, text, lang))
    extra = [(1000, None, "aa"), (1001, "", "aa"), (1002, "12 !? 34", "aa"), (1003, "the thing " * 400, None), (None, "sch ung schei", "cc"), (1, docs[1][1], docs[1][2])]
    return docs, spark.createDataFrame(docs + extra, "doc_id bigint, text string, lang string").withColumn("score", F.lit("x"))


def test_language_on_held_out_rows(spark):
    docs, frame = language_table(spark)
    net = language.train(frame, language.remainder(3) != 1, per_label=60)
    got = language.identify(frame, net).withColumn("held", language.remainder(3) == 1).collect()
    assert len(got) == 306
    truth = {i: c for i, _, c in docs}
    held = [r.lang_pred == truth[r.doc_id] for r in got if r.held and r.doc_id in truth]
    assert sum(held) / len(held) > 0.95
    odd = {r.doc_id: (r.lang_pred, r.score) for r in got if r.doc_id in (1000, 1001, 1002)}
    assert set(odd.values()) == {("und", 0.0)}
    assert language.identify(empty(spark), net).count() == 0


def test_unlabelled_table_is_undetermined(spark):
    _, frame = language_table(spark)
    net = language.train(frame.withColumn("lang", F.lit(None).cast("string")), F.lit(True))
    assert net is None and language.identify(frame, net).where("lang_pred <> 'und'").count() == 0


def test_gradients():
    rng = np.random.default_rng(1)
    net = language.ByteNet.new(["a", "b"])
    rows_, wanted = rng.integers(97, 105, (3, language.LENGTH)).astype(np.uint8), np.array([0, 1, 0])
    _, grads = net.step(rows_, wanted)
    for weight, grad in zip(net.weights(), grads, strict=True):
        at = np.unravel_index(np.abs(grad).argmax(), grad.shape)
        old, eps = weight[at], np.float32(1e-2)
        weight[at] = old + eps
        up = net.step(rows_, wanted)[0]
        weight[at] = old - eps
        down = net.step(rows_, wanted)[0]
        weight[at] = old
        assert abs((up - down) / (2 * eps) - grad[at]) < 0.1 * abs(grad[at]) + 1e-3


def test_tables_give_the_same_chances():
    net = language.ByteNet.new(["a", "b", "c"])
    rows_, owner, _ = language.cut([b"hello world " * 60, b"", "üß".encode() * 200])
    direct = []
    for row in rows_:
        hidden = []
        for bank, bias, width in zip(net.filters, net.biases, language.WIDTHS, strict=True):
            e = net.embedding[row]
            hidden.append(max_over(e, bank, width) + bias)
        direct.append(language.softmax((np.maximum(np.concatenate(hidden), 0) @ net.last + net.last_bias)[None])[0])
    assert np.allclose(net.chances(rows_), np.array(direct), atol=1e-4)
    assert owner.tolist() == sorted(owner.tolist()) and set(owner.tolist()) == {0, 1, 2}


def max_over(embedded, bank, width):
    return np.max([embedded[i:i + width].reshape(-1) @ bank for i in range(language.LENGTH - width + 1)], axis=0)


# Licences --------------------------------------------------------------------------------------


@pytest.mark.parametrize(
    "text,names,duty",
    [
        ("MIT", ["mit"], 0),
        ("(GPL-2.0-only WITH Classpath-exception-2.0) AND Apache-2.0 OR MIT", ["apache", "gpl", "mit"], 0),
        ("GPL-3.0-or-later AND (MIT OR BSD-3-Clause)", ["bsd", "gpl", "mit"], 2),
        ("GPL-2.0+ with x", ["gpl"], 1),
        ("MIT OR", ["mit"], 0),
        ("(MIT AND", ["mit"], 0),
        ("MIT */ and more", ["mit"], 0),
        ("Foo-1.0 AND MIT", ["foo-1.0", "mit"], None),
        ("and or ) (", [], None),
        ("((((MIT", ["mit"], 0),
    ],
)
def test_expressions(text, names, duty):
    assert licenses.evaluate(licenses.shunt(text)) == (names, duty)


def test_places(spark):
    extra = ["MIT License, mit-license\nApache  LICENSE general public license. mit license mit license", "SPDX-License-Identifier: MIT OR GPL-2.0-only\nx", "mit licenseé", None]
    data = list(enumerate([*texts(), *extra]))
    docs = spark.createDataFrame([(i, t, "z") for i, t in data], "doc_id bigint, text string, places string").repartition(3)
    got = {r.doc_id: r for r in licenses.summary(licenses.license_scan(docs)).collect()}
    for i, text in data:
        words, found = plain_words(text), []
        for phrase, label in licenses.BASE.items():
            parts = phrase.split()
            found += [(j, label) for j in range(len(words)) if words[j:j + len(parts)] == parts]
        r = got[i]
        assert (r.n_words, r.n_base) == (len(words), len(found))
        assert (r.first_word, r.last_word) == ((min(found)[0], max(found)[0]) if found else (None, None))
        assert r.base_labels == ",".join(sorted({x for _, x in found}))
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) or not found
        assert 0 <= r.score <= 1
    assert got[len(data) - 3].labels == "gpl,mit"
    assert licenses.license_scan(empty(spark)).count() == 0


# Tokens ----------------------------------------------------------------------------------------

ODD = [
    "", " ", "  a", "a  b\n\n c", "don't we'll x'l 're !'re", "<|endoftext|> a<|endoftext|>", "a\x1cb \x1f c", "　x  y",
    "\U0001f642 é" * 20, "x" * 3000, " \t\n", "a \n", "\x85a  b", "12345 6,7", "'ll", "word.\nNext", "a\n b", "as\n\n!1s ",
]


@pytest.fixture(scope="module")
def encoder():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    own = Tokenizer.from_file(path)
    return path, lambda t: len(own.encode(t, add_special_tokens=False))


def test_counts_equal_the_library(spark, encoder):
    path, count = encoder
    data = [(i, t) for i, t in enumerate([*texts(), *ODD])]
    docs = spark.createDataFrame([(i, t, 1) for i, t in data], "doc_id bigint, text string, n_tokens int")
    got = {r.doc_id: (r.n_bytes, r.n_tokens) for r in tokens.token_counts(docs, path).collect()}
    assert got == {i: (len((t or "").encode()), count(t or "")) for i, t in data}
    assert tokens.token_counts(empty(spark), path).count() == 0


def test_every_prefix(encoder):
    path, count = encoder
    own = tokens.counter(path)
    rng = random.Random(2)
    for text in [t for t in ODD if len(t) < 60 and "<|" not in t] + ["".join(rng.choices("ab'lsre \né!1 ", k=14)) for _ in range(150)]:
        for budget in (1, 2, 4):
            fits = [len(text[:i].encode()) for i in range(len(text) + 1) if count(text[:i]) <= budget]
            assert own.cut(text, budget) == max(fits), (text, budget)


def test_stored_prefixes_answer_without_encoding(spark, encoder):
    path, count = encoder
    text = "One two, three four five. Sixteen"
    stored = tokens.prefix_table(spark.createDataFrame([(1, text)], "doc_id bigint, text string"), path)
    row = stored.select("ends", "counts", tokens.tokens_within(8).alias("n"), tokens.units_within(3).alias("b")).first()
    assert [count(text[:e]) for e in row.ends] == row.counts
    assert row.n == count("One two,") and count(text[: row.b]) <= 3


def test_stored_prefixes_are_exact_at_every_place(spark, encoder):
    path, count = encoder
    unspaced = "数据处理的方法很多，我们先看最简单的一种。東京はとても大きいです。สวัสดีครับ"
    data = [unspaced, "QmFzZTY0L2RhdGE+" * 4, "for(i=0;i<n;i++){s+=a[i]*b[i];}", "one  two\x1cthree \n\n four \x1f  don't", "don't <|endoftext|>we'll  <|endoftext|><|endoftext|> <|end", "", None]
    docs = spark.createDataFrame(list(enumerate(data)), "doc_id bigint, text string")
    stored = tokens.prefix_table(docs, path).join(docs, "doc_id").cache()
    budgets = (1, 2, 5, 9, 20)
    cuts = {r.doc_id: r for r in tokens.token_counts(docs, path, budgets).collect()}
    places = F.transform(F.sequence(F.lit(0), F.coalesce(F.octet_length("text"), F.lit(0))), tokens.tokens_within)
    for r in stored.select("doc_id", "text", places.alias("n"), F.array(*map(tokens.units_within, budgets)).alias("bytes")).collect():
        text = r.text or ""
        raw = text.encode()
        assert r.n == [count(raw[:i].decode("utf-8", "ignore")) for i in range(len(raw) + 1)], text
        ends = [(len(text[:i].encode()), count(text[:i])) for i in range(len(text) + 1)]
        assert r.bytes == [max(e for e, n in ends if n <= b) for b in budgets] == [cuts[r.doc_id][f"cut_{b}"] for b in budgets], text


def test_the_query_answers_from_the_prefixes(spark):
    from tripmeter.llm.queries import QUERIES

    got = QUERIES["op10_token_counts"](spark, "/root/testdata/sf0.001").collect()
    assert all(r.over_limit == (r.n_tokens > 512) == (r.cut_512 < r.n_bytes) for r in got)
    assert any(0 < r.cut_512 < r.n_bytes for r in got)


# Mixing ----------------------------------------------------------------------------------------


def goals(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    out, open_, left = {}, set(names), 1.5 * sum(sizes.values())
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total > 2 * sizes[s]}
        if not over:
            out |= {s: left * weight[s] / total for s in open_}
            break
        for s in over:
            out[s] = 2.0 * sizes[s]
            left -= out[s]
        open_ -= over
    return out


def test_mixing(spark):
    got = mixing.mix(mixing.word_counts(table(spark)), scratch_path(spark, "m")).collect()
    sizes = Counter()
    for r in rows():
        sizes[r[3]] += len(words_of(r[1]))
    want = goals(dict(sizes))
    assert len(got) == len(rows())
    taken = Counter()
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6 * (1 + want[r.source])
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    assert all(abs(taken[s] - want[s]) <= 1 for s in sizes)
    again = mixing.mix(mixing.word_counts(table(spark).repartition(3)), scratch_path(spark, "m")).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_running_sums(spark):
    rng = random.Random(3)
    data = [(rng.choice(["a", "b", None]), rng.randint(0, 50), i, rng.randint(0, 9)) for i in range(500)]
    frame = spark.createDataFrame(data, "g string, k int, i int, v int")
    got = mixing.running_sums(frame, ["g"], [F.col("k"), F.col("i")], ["v"], scratch_path(spark, "r")).collect()
    for r in got:
        assert r.before_v == sum(v for g, k, i, v in data if g == r.g and (k, i) < (r.k, r.i))


def test_mixing_nothing(spark):
    assert mixing.mix(mixing.word_counts(empty(spark)), scratch_path(spark, "m")).count() == 0
    only = spark.createDataFrame([(1, None, None), (2, "", None)], "doc_id bigint, text string, source string")
    got = mixing.mix(mixing.word_counts(only), scratch_path(spark, "m")).collect()
    assert [(r.target, r.taken) for r in got] == [(0.0, 0), (0.0, 0)]
