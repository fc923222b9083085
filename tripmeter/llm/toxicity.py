"""Toxicity by weak supervision.

Many weak voters look at a text: words and word beginnings of a lexicon, and patterns of writing.
A generative label model estimates, without looking at labels, how often each voter speaks in a
toxic and in a clean text, and how far voters repeat one another; the posterior of that model is
the label on which a linear classifier over words is trained.  The classifier scores whole texts.

Labels serve two things only: choosing the lexicon, and the share of toxic texts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmeter.llm.texts import PLAIN, id_and_text, map_texts
from tripmeter.llm.words import Words, mix

#: Word beginnings that count as terms, in bytes.
BEGINNINGS = (4, 5)
#: Patterns of writing; each votes and is a feature of the classifier.
PATTERNS = ("shouting", "exclamations", "stretched", "second_person")
_SECOND = (b" you ", b" your ", b" you're ")
_BEGINNING = np.uint64(0x5851F42D4C957F2D)


def terms(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, term) pairs, sorted, and the patterns of each text.

    Terms are hashes of lower-case words, and of the first bytes of longer words.
    """
    words = Words(texts, PLAIN)
    owner = words.owner()
    whole = words.hashes()
    found, owners = [whole], [owner]
    for n in BEGINNINGS:
        long = np.flatnonzero(words.ends - words.starts > n)
        found.append(mix(words.hash_of(words.starts[long], words.starts[long] + n) ^ _BEGINNING))
        owners.append(owner[long])
    both, owners = np.concatenate(found), np.concatenate(owners)
    order = np.lexsort((both, owners))
    owners, both = owners[order], both[order]
    new = np.ones(len(both), bool)
    new[1:] = (owners[1:] != owners[:-1]) | (both[1:] != both[:-1])
    return owners[new], both[new], np.array([patterns(t or b"") for t in texts], np.float32).reshape(len(texts), len(PATTERNS))


def patterns(text: bytes) -> list[bool]:
    upper = len(text) - len(text.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    lower = len(text) - len(text.translate(None, b"abcdefghijklmnopqrstuvwxyz"))
    low = text.lower()
    return [
        upper > lower and upper > 20,
        b"!!" in text,
        any(c * 4 in low for c in (b"a", b"e", b"i", b"o", b"u")),
        any(x in low for x in _SECOND),
    ]


@dataclass
class LabelModel:
    """How often each voter speaks in toxic (``hit``) and clean texts (``slip``), and its weight.

    The weight of a voter falls with its correlation to other voters among texts of the same class,
    so voters that repeat one another count once.  A silent voter abstains: it says nothing about
    the class, as nobody uses the whole lexicon of all languages at once.
    """

    share: float
    hit: np.ndarray
    slip: np.ndarray
    weight: np.ndarray
    correlations: np.ndarray

    @classmethod
    def fit(cls, votes: np.ndarray, lexicon: int, share: float, importance: np.ndarray, rounds: int = 30) -> LabelModel:
        """``votes`` is 0 or 1 by text and voter, the first ``lexicon`` voters being the lexicon's.

        ``importance`` weighs texts to their share in the corpus.
        """
        n, m = votes.shape
        spoken = votes[:, :lexicon].sum(axis=1)
        model = cls(share, np.full(m, 0.2), np.full(m, 0.01), np.ones(m), np.zeros((m, m)))
        chance = np.where(spoken > 0, 0.9, 0.02)
        for _ in range(rounds):
            toxic, clean = importance * chance, importance * (1 - chance)
            model.hit = (toxic @ votes + 0.5) / (toxic.sum() + 2)
            model.slip = (clean @ votes + 0.05) / (clean.sum() + 2)
            chance = model.posterior(votes)
        # What is left of each vote once the class is known, and how far it goes along with others.
        rest = votes - np.outer(chance, model.hit) - np.outer(1 - chance, model.slip)
        spread = np.sqrt((rest**2 * importance[:, None]).sum(axis=0)) + 1e-9
        model.correlations = (rest * importance[:, None]).T @ rest / np.outer(spread, spread)
        strong = np.abs(model.correlations) * (np.abs(model.correlations) > 0.3)
        np.fill_diagonal(strong, 0)
        model.weight = 1 / (1 + strong.sum(axis=1))
        return model

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """Chance that each text is toxic."""
        odds = np.log(self.share / (1 - self.share)) + votes @ (self.weight * np.log(self.hit / self.slip))
        return 1 / (1 + np.exp(-np.clip(odds, -40, 40)))


@dataclass
class Classifier:
    """Weights of terms (sorted by hash) and patterns."""

    terms: np.ndarray
    weights: np.ndarray
    pattern_weights: np.ndarray
    bias: float

    def score(self, texts: list[bytes | None]) -> np.ndarray:
        owners, found, flags = terms(texts)
        odds = flags @ self.pattern_weights + self.bias
        if len(self.terms):
            at = np.minimum(np.searchsorted(self.terms, found), len(self.terms) - 1)
            known = self.terms[at] == found
            odds = odds + np.bincount(owners[known], self.weights[at[known]], len(texts))
        return 1 / (1 + np.exp(-np.clip(odds, -40, 40)))


@dataclass
class Sample:
    """Labelled texts as terms: ``rows`` and ``terms`` are the (text, term) pairs."""

    marks: np.ndarray
    flags: np.ndarray
    rows: np.ndarray
    terms: np.ndarray
    share: float


def training_rows(docs: DataFrame, labels: DataFrame, learn: Column, toxic_rows: int, clean_rows: int) -> Sample | None:
    """Terms and labels of a bounded sample of labelled texts, and the share of toxic labels in all."""
    marked = (
        labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int").alias("toxic"))
        .where(learn & F.col("toxic").isNotNull())
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    counts = {r["toxic"]: r["n"] for r in marked.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n_toxic, n_clean = counts.get(1, 0), counts.get(0, 0)
    if not n_toxic or not n_clean:
        return None
    key = F.pmod(F.xxhash64("doc_id", F.lit(72)), F.lit(1_000_000)) / 1e6
    rate = F.when(F.col("toxic") == 1, min(1.0, toxic_rows / n_toxic)).otherwise(min(1.0, clean_rows / n_clean))
    # The limit only bounds what is broadcast: the shares above give about half of it.
    chosen = marked.where(key < rate).orderBy(key, "doc_id").limit(2 * (toxic_rows + clean_rows))
    rows = id_and_text(docs).join(F.broadcast(chosen), "doc_id")

    def compute(texts: list[bytes | None]) -> list:
        owners, found, flags = terms(texts)
        cuts = np.searchsorted(owners, np.arange(len(texts) + 1))
        return [[found[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)], [f.tobytes() for f in flags]]

    got = map_texts(rows, compute, "terms binary, flags binary", keep=("doc_id", "toxic")).toArrow()
    got = got.sort_by([("doc_id", "ascending"), ("terms", "ascending")]).combine_chunks()
    sizes = np.array([len(t.as_py()) // 8 for t in got.column("terms")], np.int64)
    return Sample(
        got.column("toxic").to_numpy().astype(np.int64),
        np.frombuffer(b"".join(got.column("flags").to_pylist()), np.float32).reshape(-1, len(PATTERNS)).astype(np.float64),
        np.repeat(np.arange(len(sizes), dtype=np.int32), sizes),
        np.frombuffer(b"".join(got.column("terms").to_pylist()), np.uint64),
        n_toxic / (n_toxic + n_clean),
    )


def train(
    docs: DataFrame,
    labels: DataFrame,
    learn: Column,
    toxic_rows: int = 2000,
    clean_rows: int = 3000,
    lexicon: int = 96,
    features: int = 4096,
) -> Classifier:
    """A classifier fitted on at most about ``toxic_rows + clean_rows`` labelled texts that ``learn`` admits.

    Without labels of both kinds every text scores 0.
    """
    sample = training_rows(docs, labels, learn, toxic_rows, clean_rows)
    if sample is None or not 0 < sample.marks.sum() < len(sample.marks):
        return Classifier(np.zeros(0, np.uint64), np.zeros(0), np.zeros(len(PATTERNS)), -40.0)
    marks, flags, rows, share, n = sample.marks, sample.flags, sample.rows, sample.share, len(sample.marks)
    vocabulary, term = np.unique(sample.terms, return_inverse=True)
    term = term.astype(np.int32)
    in_toxic = np.bincount(term, marks[rows], len(vocabulary))
    in_clean = np.bincount(term, 1 - marks[rows], len(vocabulary))
    n_toxic, n_clean = marks.sum(), (1 - marks).sum()
    odds = np.log((in_toxic + 0.1) / (n_toxic + 1)) - np.log((in_clean + 0.1) / (n_clean + 1))

    # Voters: the terms that speak for toxicity most clearly and often, and the patterns.
    clear = np.where((in_toxic >= 4) & (odds > 4.5), odds * np.sqrt(in_toxic), -1)
    chosen = np.argsort(-clear, kind="stable")[:lexicon]
    chosen = chosen[clear[chosen] > 0]
    place = np.full(len(vocabulary), -1)
    place[chosen] = np.arange(len(chosen))
    votes = np.zeros((n, len(chosen)))
    voting = place[term] >= 0
    votes[rows[voting], place[term[voting]]] = 1
    nothing = votes.sum(axis=1, keepdims=True) == 0  # a voter for clean
    importance = np.where(marks == 1, share / n_toxic, (1 - share) / n_clean) * n
    model = LabelModel.fit(np.concatenate([votes, flags, nothing], axis=1), len(chosen), share, importance)
    wanted = model.posterior(np.concatenate([votes, flags, nothing], axis=1))

    # The classifier sees the terms whose presence clearly goes along with the posterior.
    balance = importance / importance.sum()
    mean = float(balance @ wanted)
    seen = np.bincount(term, minlength=len(vocabulary))
    toxic_seen = np.bincount(term, wanted[rows], len(vocabulary))
    lean = (toxic_seen - seen * wanted.mean()) / np.sqrt(seen * wanted.mean() * (1 - wanted.mean()) + 1e-9)
    used = np.argsort(-np.where(seen >= 3, np.abs(lean), -1), kind="stable")[:features]
    used = np.sort(used[(seen[used] >= 3) & (np.abs(lean[used]) > 4)])
    number = np.full(len(vocabulary), -1)
    number[used] = np.arange(len(used))
    kept = number[term] >= 0
    at_row, at_term = rows[kept], number[term[kept]]
    k = len(used)
    theta = np.zeros(k + len(PATTERNS) + 1)
    theta[-1] = np.log(mean / (1 - mean))
    penalty = np.full(len(theta), 1e-5)
    penalty[-1] = 0
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, 401):
        z = np.bincount(at_row, theta[at_term], n) + flags @ theta[k:-1] + theta[-1]
        error = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - wanted) * balance
        grad = np.concatenate([np.bincount(at_term, error[at_row], k), flags.T @ error, [error.sum()]]) + penalty * theta
        first += 0.1 * (grad - first)
        second += 0.01 * (grad**2 - second)
        theta -= 0.05 * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.99**t)) + 1e-9)
    weights, pattern_weights, bias = theta[:k], theta[k:-1], theta[-1]
    return Classifier(vocabulary[used], weights, pattern_weights, float(bias))


def toxicity(docs: DataFrame, model: Classifier) -> DataFrame:
    """``doc_id, score`` of every whole text.

    A null or empty text scores as one without any term.  Rows that repeat give a row each; other
    columns of ``docs`` are not read.
    """
    return map_texts(id_and_text(docs), lambda texts: [model.score(texts)], "score double")
