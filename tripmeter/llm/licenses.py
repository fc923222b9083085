"""License scan: one automaton finds identifier tags and notice phrases, a parser reads the tags' expressions.

A text is first turned into lower-case words parted by single spaces; an Aho-Corasick automaton
over all phrases then passes over it once, whatever the number of phrases.  Where it meets an
identifier tag, the expression after the tag is read from the original text.
"""

from __future__ import annotations

import re
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmeter.llm.texts import PLAIN, id_and_text, map_texts

#: Phrases that name a licence for sure, and their labels (fixed values).
BASE = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}
#: Phrases of licence notices, and their labels (fixed values).
NOTICES = {
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "licensed under the apache license": "apache",
    "redistribution and use in source and binary forms": "bsd",
    "bsd license": "bsd",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "isc license": "isc",
    "boost software license": "bsl",
    "creative commons attribution": "cc-by",
    "licensed under cc by": "cc-by",
    "licensed under cc0": "cc0",
    "creative commons zero": "cc0",
    "this is free and unencumbered software released into the public domain": "unlicense",
}
TAG = "spdx license identifier"
#: How much a licence asks for: 0 notice only, 1 its own files stay open, 2 the whole work does (fixed values).
DUTIES = {
    "mit": 0, "apache": 0, "bsd": 0, "isc": 0, "bsl": 0, "cc0": 0, "unlicense": 0, "zlib": 0, "cc-by": 0,
    "lgpl": 1, "mpl": 1, "epl": 1, "gpl": 2, "agpl": 2,
}
#: Confidence in each kind of evidence.
CONFIDENCE = {"base": 0.6, "notice": 0.8, "tag": 0.9}

_TAG = re.compile(r"spdx[^0-9a-z\x80-\U0010ffff]+license[^0-9a-z\x80-\U0010ffff]+identifier[^0-9a-z(\n\r\x80-\U0010ffff]*([^\n\r]*)", re.IGNORECASE | re.ASCII)
_TOKEN = re.compile(r"[()]|[A-Za-z0-9][A-Za-z0-9.:+-]*")
_STRENGTH = {"OR": 1, "AND": 2, "WITH": 3}


def shunt(text: str) -> list[str]:
    """The expression at the start of a line in postfix order; what does not belong to it is left out.

    Words beyond the first complete expression end it, as do unknown signs; an operator without a
    right side is dropped, and an open parenthesis is closed at the end.
    """
    out: list[str] = []
    held: list[str] = []
    operand_next, at = True, 0
    while True:
        while at < len(text) and text[at] in " \t":
            at += 1
        match = _TOKEN.match(text, at)
        if not match:
            break
        token, at = match[0], match.end()
        upper = token.upper()
        if token == "(":
            if not operand_next:
                break
            held.append(token)
        elif token == ")":
            if operand_next or "(" not in held:
                break
            while held[-1] != "(":
                out.append(held.pop())
            held.pop()
        elif upper in _STRENGTH:
            if operand_next:
                break
            while held and held[-1] != "(" and _STRENGTH[held[-1]] >= _STRENGTH[upper]:
                out.append(held.pop())
            held.append(upper)
            operand_next = True
        else:
            if not operand_next:
                break
            out.append(token)
            operand_next = False
    if operand_next:  # an operator or parenthesis at the end lacks its right side
        while held and (held[-1] == "(" or out):
            dropped = held.pop()
            if dropped != "(":
                break
    while held:
        operator = held.pop()
        if operator != "(":
            out.append(operator)
    return out


def family(identifier: str) -> str:
    """``GPL-2.0-or-later`` is ``gpl``; unknown identifiers stay as they are, in lower case."""
    low = identifier.lower().rstrip("+")
    return next((f for f in sorted(DUTIES, key=len, reverse=True) if low == f or low.startswith(f + "-")), low)


def evaluate(postfix: list[str]) -> tuple[list[str], int | None]:
    """Licences that an expression names, and the duty of its mildest choice (None: one is unknown).

    Of ``a OR b`` the milder counts, of ``a AND b`` the stricter; ``a WITH e`` keeps a's name and
    takes one degree off its duty, as exceptions allow more.
    """
    stack: list[tuple[set[str], int | None]] = []
    for token in postfix:
        if token in _STRENGTH and len(stack) >= 2:
            (right, more), (left, less) = stack.pop(), stack.pop()
            if token == "WITH":
                stack.append((left, None if less is None else max(0, less - 1)))
            elif token == "AND":
                stack.append((left | right, None if less is None or more is None else max(less, more)))
            else:
                known = [d for d in (less, more) if d is not None]
                stack.append((left | right, min(known) if known else None))
        elif token not in _STRENGTH:
            name = family(token)
            stack.append(({name}, DUTIES.get(name)))
    names, duty = stack[-1] if stack else (set(), None)
    return sorted(names), duty


@lru_cache(maxsize=1)
def automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    kinds: dict[str, list[tuple[str, str, int]]] = {}
    for kind, phrases in (("base", BASE), ("notice", NOTICES), ("tag", {TAG: ""})):
        for phrase, label in phrases.items():
            kinds.setdefault(phrase, []).append((kind, label, len(phrase)))
    for phrase, what in kinds.items():
        found.add_word(f" {phrase} ", (phrase, what))
    found.make_automaton()
    return found


def scan(raw: bytes) -> tuple[int, list[dict], list[dict]]:
    """Words, places and expressions of one text."""
    words = raw.translate(PLAIN).split()
    plain = " " + b" ".join(words).decode("latin-1") + " "
    places, tagged = [], False
    word = at = 0
    for end, (phrase, what) in automaton().iter(plain):
        begin = end - len(phrase) - 1
        word, at = word + (plain.count(" ", at, begin) if begin >= at else -plain.count(" ", begin, at)), begin
        for kind, label, _ in what:
            tagged |= kind == "tag"
            places.append({"kind": kind, "phrase": phrase, "label": label, "word": word})
    expressions = []
    if tagged:
        for match in _TAG.finditer(raw.decode("utf-8", "replace")):
            names, duty = evaluate(shunt(match[1]))
            if names:
                expressions.append({"text": match[1].strip(), "labels": names, "duty": duty})
    return len(words), places, expressions


def license_scan(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, places, expressions`` of every document.

    A place is (kind ``base``, ``notice`` or ``tag``, phrase, label, first word counted from 0);
    phrases may overlap and each place counts.  An expression has its text, the licences it names
    and the duty of its mildest choice.  A null or empty text has no words, places or expressions;
    rows that repeat give a row each; other columns of ``docs`` are not read.
    """

    def compute(texts: list[bytes | None]) -> list:
        found = [scan(t or b"") for t in texts]
        return [[f[i] for f in found] for i in range(3)]

    return map_texts(
        id_and_text(docs),
        compute,
        "n_words bigint, places array<struct<kind:string,phrase:string,label:string,word:bigint>>, "
        "expressions array<struct<text:string,labels:array<string>,duty:int>>",
    )


def summary(scanned: DataFrame) -> DataFrame:
    """Counts, labels and a score for each row of :func:`license_scan`.

    ``score`` is the chance that at least one kind of evidence is right, kinds taken as independent.
    """
    base = F.filter("places", lambda p: p["kind"] == "base")
    starts = F.transform(base, lambda p: p["word"])
    base_labels = F.array_sort(F.array_distinct(F.transform(base, lambda p: p["label"])))
    named = F.filter("places", lambda p: p["kind"] != "tag")
    labels = F.array_union(
        F.array_distinct(F.transform(named, lambda p: p["label"])),
        F.flatten(F.transform("expressions", lambda e: e["labels"])),
    )
    missed = F.lit(1.0)
    for kind in ("base", "notice"):
        seen = F.array_contains(F.col("places.kind"), kind)
        missed *= F.when(seen, 1 - CONFIDENCE[kind]).otherwise(1.0)
    missed *= F.when(F.size("expressions") > 0, 1 - CONFIDENCE["tag"]).otherwise(1.0)
    return scanned.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        F.array_join(base_labels, ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(labels)), ",").alias("labels"),
        (1 - missed).alias("score"),
    )
