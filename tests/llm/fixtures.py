"""Small tables with all that real ones may hold: nulls, empty and long texts, copies, repeated rows, clashing columns."""

from __future__ import annotations

import random
import re

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, n_words string, fp string, score string, key string, block string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall(text or "")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def plain_words(text):
    return PLAIN_WORD.findall(lower(text))


def texts(seed: int = 3, n: int = 60) -> list[str | None]:
    rng = random.Random(seed)
    stems = ["al", "be", "ço", "dé", "el", "fü", "go", "hy", "is", "jo", "ka", "lu"]
    vocabulary = ["".join(rng.choices(stems, k=rng.randint(1, 3))) for _ in range(400)]
    prose = lambda k: " ".join(rng.choice(vocabulary) + rng.choice(["", "", "", ".", ","]) for _ in range(k))
    passage, line = prose(70), prose(12)
    out: list[str | None] = []
    for i in range(n):
        text = prose(rng.randint(1, 120))
        if i % 5 == 0:
            text = text + " " + passage + "\n" + prose(20)
        if i % 7 == 0:
            text += f"\n{line}\n{line}\n" + prose(3)
        if i % 11 == 0 and out[-1:] and out[-1]:
            text = out[-1]
        if i % 13 == 0 and out[-1:] and out[-1]:
            text = out[-1].replace("al", "AL", 1) + " x"
        out.append(text)
    out += [None, "", "   \n\t ", "123 !!!", "x", prose(4000), "ab " * 300, "\U0001f600 " * 40, "y" * 700, None, ""]
    return out


def rows(seed: int = 3, n: int = 60) -> list[tuple]:
    """Rows of SCHEMA; the last ones repeat an id, an id and text, or have no id."""
    out = []
    for i, text in enumerate(texts(seed, n)):
        lang, source = [("en", "s1"), ("de", "s2"), ("en", None), (None, "s1")][i % 4]
        out.append((i * 3 + 1, text, lang, source, None if text is None else len(text), "q", "f", "s", "k", "b"))
    again = out[5]
    return [*out, again, (again[0], "another text of the same id", *again[2:]), (None, out[10][1], *again[2:]), (None, None, None, None, None, None, None, None, None, None)]


def table(spark, seed: int = 3, n: int = 60):
    return spark.createDataFrame(rows(seed, n), SCHEMA).repartition(5)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
