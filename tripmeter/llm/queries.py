"""Queries of the operators in this folder: each applies one to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmeter.llm import (
    contamination,
    exact,
    language,
    licenses,
    mixing,
    negatives,
    quality,
    simhash,
    substrings,
    suffix_dedup,
    tokens,
    toxicity,
    trie,
)
from tripmeter.llm.texts import documents
from tripmeter.session import scratch_path

TOKEN_FILE = "byte_bpe_50k.json"
TOKEN_LIMIT = 512
TOXIC_FROM = 0.3


def _removed(spans: str) -> Column:
    """Symbols inside disjoint spans."""
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["begin"])


def op1_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Words of every document inside windows that also stand elsewhere."""
    found = substrings.deduplicated(documents(spark, folder))
    return found.select("doc_id", "n_words", _removed("spans").alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))


def op2_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes of every document inside strings that start earlier."""
    found = suffix_dedup.deduplicated(documents(spark, folder))
    return found.select(
        "doc_id", "n_bytes", _removed("spans").alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op3_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Words of every document that stand in windows of benchmark items."""
    found = contamination.contamination(
        documents(spark, folder), spark.read.parquet(f"{folder}/benchmark.parquet"), scratch_path(spark, "contamination")
    )
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), contamination.contaminated().alias("contaminated"),
    )


def op4_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """What the mix takes from every document."""
    mixed = mixing.mix(mixing.word_counts(documents(spark, folder)), scratch_path(spark, "mixing"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op5_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Counts of every document and the verdict of the limits of its language and source."""
    judged = quality.quality(documents(spark, folder), scratch_path(spark, "quality"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        *quality.RARE,
    )


def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity score of every document; a quarter of them is held out from learning."""
    docs, labels = documents(spark, folder), spark.read.parquet(f"{folder}/labels.parquet")
    model = toxicity.train(docs, labels, language.remainder(4) != 2)
    held_out = F.coalesce(language.remainder(4) == 2, F.lit(False))
    predicted = (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted")
    return toxicity.toxicity(docs, model).select("doc_id", held_out.alias("held_out"), "score", predicted)


def op7_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Predicted language of every document; a third of them is held out from learning."""
    docs = documents(spark, folder)
    held_out = F.coalesce(language.remainder(3) == 1, F.lit(False))
    net = language.train(docs, language.remainder(3) != 1)
    return language.identify(docs, net).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op8_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = simhash.near_duplicates(documents(spark, folder), scratch_path(spark, "simhash"))
    return found.select("doc_id", simhash.as_hex(F.col("fp")).alias("fingerprint"), "component_id")


def op9_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Licence phrases, tags and labels of every document."""
    return licenses.summary(licenses.license_scan(documents(spark, folder)))


def op10_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Exact token counts of every document, and the bytes of it that hold the limit."""
    counted = tokens.token_counts(documents(spark, folder), public_tokenizers.path(TOKEN_FILE), [TOKEN_LIMIT])
    return counted.withColumn("over_limit", F.col(f"cut_{TOKEN_LIMIT}") < F.col("n_bytes"))


def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Hard negatives of every anchor and positive among all embeddings."""
    rows, scratch = spark.read.parquet(f"{folder}/embeddings.parquet"), scratch_path(spark, "negatives")
    key, label = F.col("vec_id").cast("long"), F.col("label").cast("long")
    moved = F.when(key % 7 == 0, (label + 1) % 10).otherwise(label)
    codes = negatives.prepared(rows, f"{scratch}/codes", "embedding", key, moved, key % 100 == 0)
    return negatives.hard_negatives(codes, scratch).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


def op12_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Which document stays for every document."""
    found = exact.exact_duplicates(documents(spark, folder), scratch_path(spark, "exact"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    """All nodes of the trie of rebuilt conversations."""
    paths = trie.with_heads(trie.conversation_paths(spark.read.parquet(f"{folder}/conversations.parquet")))
    return trie.prefix_trie(paths, scratch_path(spark, "trie"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_decontamination": op3_decontamination,
    "op4_mixing": op4_mixing,
    "op5_quality_rules": op5_quality_rules,
    "op6_toxicity": op6_toxicity,
    "op7_language_id": op7_language_id,
    "op8_simhash": op8_simhash,
    "op9_license_scan": op9_license_scan,
    "op10_token_counts": op10_token_counts,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_exact_dedup": op12_exact_dedup,
    "op13_prefix_trie": op13_prefix_trie,
}
ORACLES: dict[str, str] = {
    # Starts of repeated windows that lie at most a window apart make one span ("island").
    "op1_substring_dedup": r"""
        WITH docs AS (
            SELECT row_number() OVER () AS row, doc_id,
                coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS words
            FROM documents
        ), found AS (
            SELECT row, s, md5(array_to_string(words[s:s + 34], ' ')) AS phrase
            FROM (SELECT row, words, unnest(range(1, len(words) - 33)) AS s FROM docs WHERE len(words) >= 35)
        ), again AS (
            SELECT row, s FROM (SELECT row, s, count(*) OVER (PARTITION BY phrase) AS n FROM found) WHERE n > 1
        ), islands AS (
            SELECT row, min(s) AS first, max(s) + 35 AS past FROM (
                SELECT row, s, count(*) FILTER (WHERE fresh) OVER (PARTITION BY row ORDER BY s) AS island FROM (
                    SELECT row, s, coalesce(s > lag(s) OVER (PARTITION BY row ORDER BY s) + 35, true) AS fresh FROM again))
            GROUP BY row, island
        ), pieces AS (
            SELECT row, past - first AS gone, first, past, lag(past, 1, 1) OVER (PARTITION BY row ORDER BY first) AS since
            FROM islands
        ), cut AS (
            SELECT row, sum(gone) AS gone, max(past) AS past, list(struct_pack(since := since, first := first) ORDER BY first) AS parts
            FROM pieces GROUP BY row
        )
        SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(gone, 0)::BIGINT AS n_removed,
            sha256(array_to_string(
                flatten(list_transform(coalesce(parts, []), lambda p: words[p.since:p.first - 1])) || words[coalesce(past, 1):], ' ')) AS kept_sha256
        FROM docs LEFT JOIN cut USING (row)
    """,
    "op2_suffix_dedup": r"""
        WITH docs AS (
            SELECT row_number() OVER () AS row, doc_id, hex(encode(coalesce(text, ''))) AS digits FROM documents
        ), found AS (
            SELECT row, doc_id, s, md5(substr(digits, 2 * s - 1, 200)) AS phrase
            FROM (SELECT row, doc_id, digits, unnest(range(1, len(digits) // 2 - 98)) AS s FROM docs WHERE len(digits) >= 200)
        ), again AS (
            SELECT row, s FROM (SELECT row, s, row_number() OVER (PARTITION BY phrase ORDER BY doc_id, row, s) AS n FROM found) WHERE n > 1
        ), islands AS (
            SELECT row, min(s) AS first, max(s) + 100 AS past FROM (
                SELECT row, s, count(*) FILTER (WHERE fresh) OVER (PARTITION BY row ORDER BY s) AS island FROM (
                    SELECT row, s, coalesce(s > lag(s) OVER (PARTITION BY row ORDER BY s) + 100, true) AS fresh FROM again))
            GROUP BY row, island
        ), pieces AS (
            SELECT row, first, past, lag(past, 1, 1) OVER (PARTITION BY row ORDER BY first) AS since FROM islands
        ), cut AS (
            SELECT row, sum(past - first) AS gone, count(*) AS spans, max(past) AS past,
                string_agg(substr(digits, 2 * since - 1, 2 * (first - since)), '' ORDER BY first) AS kept
            FROM pieces JOIN docs USING (row) GROUP BY row
        )
        SELECT doc_id, (len(digits) // 2)::BIGINT AS n_bytes, coalesce(gone, 0)::BIGINT AS n_removed,
            coalesce(spans, 0)::BIGINT AS n_spans,
            sha256(unhex(coalesce(kept, '') || substr(digits, 2 * coalesce(past, 1) - 1))) AS kept_sha256
        FROM docs LEFT JOIN cut USING (row)
    """,
    # Buckets and limits as in ``quality``: 2 % buckets, the third quartile plus eight spreads, wider groups for small ones.
    "op5_quality_rules": r"""
        WITH docs AS (
            SELECT row_number() OVER () AS row, doc_id, lang, source, coalesce(text, '') AS text,
                coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS words,
                list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
            FROM documents
        ), found AS (
            SELECT row, s, array_to_string(words[s:s + 7], ' ') AS phrase
            FROM (SELECT row, words, unnest(range(1, len(words) - 6)) AS s FROM docs WHERE len(words) >= 8)
        ), again AS (
            SELECT row, s FROM (SELECT row, s, count(*) OVER (PARTITION BY row, phrase) AS n FROM found) WHERE n > 1
        ), covered AS (
            SELECT row, count(DISTINCT spot) AS n FROM (SELECT row, unnest(range(s, s + 8)) AS spot FROM again) GROUP BY row
        ), counted AS (
            SELECT row, doc_id, lang, source, len(words)::BIGINT AS n_words,
                length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
                len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
                (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, len(lines) AS n_lines,
                coalesce(n, 0)::BIGINT AS n_repeat_words
            FROM docs LEFT JOIN covered USING (row)
        ), measured AS (
            SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
                coalesce(n_symbols::DOUBLE / nullif(word_chars, 0), 0) AS symbol_share,
                coalesce(n_dup_lines::DOUBLE / nullif(n_lines, 0), 0) AS dup_line_share,
                coalesce(word_chars::DOUBLE / nullif(n_words, 0), 0) AS word_length,
                coalesce(n_repeat_words::DOUBLE / nullif(n_words, 0), 0) AS repeat_share
            FROM counted
        ), long AS (
            SELECT lang, source, unnest(['symbol_share', 'dup_line_share', 'word_length', 'repeat_share']) AS metric,
                unnest([symbol_share, dup_line_share, word_length, repeat_share]) AS value
            FROM measured WHERE NOT base_failed
        ), buckets AS (
            SELECT grouping(lang) + grouping(source) AS level, lang, source, metric, bucket, count(*) AS n FROM (
                SELECT *, CASE WHEN value <= 1e-9 THEN -1000 ELSE ceil(ln(value) / ln(1.02::DOUBLE)) END AS bucket FROM long)
            GROUP BY GROUPING SETS ((lang, source, metric, bucket), (lang, metric, bucket), (metric, bucket))
        ), running AS (
            SELECT *, CASE WHEN bucket = -1000 THEN 0 ELSE pow(1.02::DOUBLE, bucket) END AS ends,
                sum(n) OVER (PARTITION BY level, lang, source, metric ORDER BY bucket) AS up_to,
                sum(n) OVER (PARTITION BY level, lang, source, metric) AS total
            FROM buckets
        ), quartiles AS (
            SELECT level, lang, source, metric, any_value(total) AS total, min(ends) FILTER (WHERE up_to >= 0.5::DOUBLE * total) AS q0,
                min(ends) FILTER (WHERE up_to >= 0.75::DOUBLE * total) AS q1
            FROM running GROUP BY ALL
        ), fences AS (
            SELECT *, CASE WHEN q1 > 0 THEN q1 + 8 * greatest(q1 - q0, q1 * (1.02::DOUBLE - 1)) END AS fence FROM quartiles
        ), limits AS (
            SELECT o.lang, o.source, o.metric, coalesce(
                CASE WHEN o.total >= 100 THEN o.fence WHEN l.total >= 100 THEN l.fence ELSE w.fence END,
                CASE o.metric WHEN 'symbol_share' THEN 0.1::DOUBLE WHEN 'dup_line_share' THEN 0.5::DOUBLE
                    WHEN 'word_length' THEN 7.0::DOUBLE ELSE 0.3::DOUBLE END) AS most
            FROM fences o JOIN fences l ON o.lang IS NOT DISTINCT FROM l.lang AND o.metric = l.metric
            JOIN fences w ON o.metric = w.metric WHERE o.level = 0 AND l.level = 1 AND w.level = 2
        ), beyond AS (
            SELECT DISTINCT row FROM measured m JOIN limits l
            ON m.lang IS NOT DISTINCT FROM l.lang AND m.source IS NOT DISTINCT FROM l.source
            WHERE CASE metric WHEN 'symbol_share' THEN symbol_share WHEN 'dup_line_share' THEN dup_line_share
                WHEN 'word_length' THEN word_length ELSE repeat_share END > most
        )
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
            NOT base_failed AND row NOT IN (SELECT row FROM beyond) AS kept,
            symbol_share, dup_line_share, word_length, repeat_share
        FROM measured
    """,
    "op3_decontamination": r"""
        WITH doc_words AS (
            SELECT row_number() OVER () AS row, doc_id,
                coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS words
            FROM documents
        ), item_words AS (
            SELECT coalesce(item_id::VARCHAR, '') AS item_id,
                regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
            FROM benchmark
        ), sizes AS (
            SELECT item_id, words, least(len(words), 13) AS size FROM item_words WHERE len(words) > 0
        ), item_windows AS (
            SELECT DISTINCT item_id, size, array_to_string(words[s:s + size - 1], ' ') AS phrase
            FROM (SELECT item_id, size, words, unnest(range(1, len(words) - size + 2)) AS s FROM sizes)
        ), doc_windows AS (
            SELECT row, s, size, array_to_string(words[s:s + size - 1], ' ') AS phrase
            FROM (SELECT row, words, size, unnest(range(1, len(words) - size + 2)) AS s
                  FROM doc_words, (SELECT DISTINCT size FROM sizes))
        ), hits AS (
            SELECT row, s, size, item_id FROM doc_windows JOIN item_windows USING (size, phrase)
        ), hit_words AS (
            SELECT row, count(DISTINCT spot) AS n_hit
            FROM (SELECT DISTINCT row, unnest(range(s, s + size)) AS spot FROM (SELECT DISTINCT row, s, size FROM hits))
            GROUP BY row
        ), hit_items AS (
            SELECT row, list_sort(list(DISTINCT item_id)) AS items FROM hits GROUP BY row
        )
        SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
            len(coalesce(items, []))::BIGINT AS n_items,
            sha256(array_to_string(coalesce(items, []), ',')) AS items_sha256,
            coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
        FROM doc_words LEFT JOIN hit_words USING (row) LEFT JOIN hit_items USING (row)
    """,
    "op4_mixing": r"""
        WITH sized AS (
            SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
            FROM documents
        ), per_source AS (
            SELECT source, sum(size)::BIGINT AS source_size,
                [3, 1, 2][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight
            FROM sized GROUP BY source
        ), filling AS (
            SELECT *, 2 * source_size / weight::DOUBLE AS full_at,
                coalesce(sum(2 * source_size) OVER earlier, 0)::DOUBLE AS given,
                sum(weight) OVER () - coalesce(sum(weight) OVER earlier, 0) AS open,
                1.5 * (sum(source_size) OVER ())::DOUBLE AS budget
            FROM per_source
            WINDOW earlier AS (ORDER BY 2 * source_size / weight::DOUBLE, source NULLS LAST
                               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
        ), level AS (
            SELECT min((budget - given) / open::DOUBLE) AS height FROM (
                SELECT * FROM filling WHERE given + full_at * open >= budget
                ORDER BY full_at, open DESC LIMIT 1)
        ), goals AS (
            SELECT source, source_size,
                least(2.0::DOUBLE * source_size, weight * coalesce((SELECT height FROM level), 1e300::DOUBLE)) AS target
            FROM filling
        ), placed AS (
            SELECT *, (coalesce(sum(size) OVER (
                PARTITION BY source ORDER BY md5('mix:' || coalesce(doc_id::VARCHAR, '')), doc_id, size
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS stand_before
            FROM sized
        )
        SELECT p.doc_id, p.size, g.source_size, g.target,
            CASE WHEN g.source_size = 0 THEN 0 ELSE
                floor(g.target)::BIGINT // g.source_size * p.size
                + greatest(0, least(p.size, floor(g.target)::BIGINT % g.source_size - stand_before)) END::BIGINT AS taken
        FROM placed p JOIN goals g ON p.source IS NOT DISTINCT FROM g.source
    """,
    "op11_hard_negatives": r"""
        WITH rows AS (
            SELECT row_number() OVER () AS row, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label END AS label,
                list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS vec
            FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL
                AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT a.row AS a_row, a.vec_id AS anchor_id, b.row AS b_row, b.vec_id AS other_id, a.label = b.label AS same,
                list_inner_product(a.vec, b.vec)::BIGINT AS score
            FROM rows a JOIN rows b ON a.row <> b.row WHERE a.vec_id % 100 = 0
        ), positives AS (
            SELECT a_row, anchor_id, b_row, other_id AS positive_id, score AS positive_score FROM (
                SELECT *, row_number() OVER (PARTITION BY a_row ORDER BY score DESC, other_id NULLS LAST, b_row) AS n FROM scored WHERE same)
            WHERE n <= 5
        ), negatives AS (
            SELECT p.anchor_id, p.positive_id, p.positive_score, s.other_id AS negative_id, s.score AS negative_score,
                row_number() OVER (PARTITION BY p.a_row, p.b_row ORDER BY s.score DESC, s.other_id NULLS LAST, s.b_row)::INTEGER AS rank
            FROM positives p JOIN scored s ON p.a_row = s.a_row AND NOT s.same
                AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
        )
        SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM negatives WHERE rank <= 10
    """,
    "op12_exact_dedup": r"""
        WITH docs AS (
            SELECT doc_id, length(coalesce(text, '')) AS n_chars, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS plain
            FROM documents
        )
        SELECT doc_id, first_value(doc_id) OVER ranked AS keep_id, count(*) OVER (PARTITION BY plain) AS group_size,
            row_number() OVER ranked = 1 AS kept, sha256(plain) AS text_sha256
        FROM docs WINDOW ranked AS (PARTITION BY plain ORDER BY n_chars DESC, doc_id NULLS LAST
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
    """,
    # crc32 bit by bit: a byte is mixed in, then eight shifts (-1) follow.
    "op13_prefix_trie": r"""
        WITH turns AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
        ), own AS (
            SELECT conv_id, list(struct_pack(k := md5(length(role) || ':' || role || text), w := len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')))
                ORDER BY turn NULLS FIRST, sha256(length(role) || ':' || role || text)[:32]) AS path
            FROM turns GROUP BY conv_id
        ), hashed AS (
            SELECT conv_id, path, conv_id - conv_id % 20 AS base, (xor(list_reduce(
                [4294967295::BIGINT] || flatten(list_transform(string_split(conv_id::VARCHAR, ''), lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])),
                lambda r, x: CASE WHEN x >= 0 THEN xor(r, x) WHEN r % 2 = 1 THEN xor(r >> 1, 3988292384::BIGINT) ELSE r >> 1 END
            ), 4294967295::BIGINT) % 4)::INT AS h FROM own
        ), rebuilt AS (
            SELECT c.conv_id, coalesce(b.path[1:c.h], []) || c.path[c.h + 1:] AS path
            FROM hashed c LEFT JOIN own b ON c.base = b.conv_id
        ), steps AS (
            SELECT conv_id, len(path) AS n, d, md5(array_to_string(list_transform(path[1:d], lambda t: t.k), ',')) AS node,
                CASE WHEN d > 0 THEN md5(array_to_string(list_transform(path[1:d - 1], lambda t: t.k), ',')) END AS parent,
                CASE WHEN d > 0 THEN path[d].w ELSE 0 END AS words
            FROM (SELECT conv_id, path, unnest(range(len(path) + 1)) AS d FROM rebuilt)
        ), nodes AS (
            SELECT node, any_value(parent) AS parent, any_value(d) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
                (count(*) - 1) * any_value(words) AS saved,
                coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE n = d), '') AS ends
            FROM steps GROUP BY node
        ), families AS (
            SELECT parent AS node, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY parent
        ), above AS (
            SELECT DISTINCT s.node, a.node AS ancestor FROM steps s JOIN steps a ON s.conv_id = a.conv_id AND a.d <= s.d
        ), totals AS (
            SELECT ancestor AS node, sum(saved)::BIGINT AS saved_tokens, count(*) FILTER (WHERE f.node IS NULL) AS n_leaves
            FROM above JOIN nodes USING (node) LEFT JOIN families f USING (node) GROUP BY ancestor
        )
        SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(f.n_children, 0) AS n_children,
            t.n_leaves, t.saved_tokens, sha256(n.ends) AS ends_sha256
        FROM nodes n LEFT JOIN nodes p ON n.parent = p.node LEFT JOIN families f ON n.node = f.node JOIN totals t ON n.node = t.node
    """,
}
