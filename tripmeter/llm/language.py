"""Language identification by a byte convolutional network written in numpy.

Bytes are embedded, filters of several widths run over them, each filter keeps its largest answer
in a window of fixed length, and a softmax over the pooled answers gives the languages.  Texts of
any length are cut into overlapping windows so that every byte sequence as long as the widest
filter lies in one; a text's answer is the mean over its windows, weighted by their letters.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmeter.llm.texts import id_and_text, map_texts

LENGTH = 256
WIDTHS = (2, 3, 4)
FILTERS = 12
EMBEDDED = 8
UNKNOWN = "und"

#: A-Z become a-z; digits, signs and controls become spaces: what is written in tells, not how it is adorned.
_FOLD = np.array([c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256)], np.uint8)


def has_letter(text: str) -> bool:
    """Whether any character is a letter (Unicode category L)."""
    return any(map(str.isalpha, text))


def cut(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows (rows of LENGTH bytes, 0 beyond the end), the text of each, and its letters."""
    step = LENGTH - max(WIDTHS) + 1
    data = np.frombuffer(b"".join(t or b"" for t in texts) + bytes(LENGTH), np.uint8)
    sizes = np.array([len(t or b"") for t in texts], np.int64)
    begins = np.cumsum(sizes) - sizes
    each = np.maximum(1, -(-(sizes - (LENGTH - step)) // step))
    owner = np.repeat(np.arange(len(texts)), each)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(each) - each, each)
    start = begins[owner] + number * step
    filled = np.clip(begins[owner] + sizes[owner] - start, 0, LENGTH)
    rows = _FOLD[np.lib.stride_tricks.sliding_window_view(data, LENGTH)[start]]
    rows[np.arange(LENGTH) >= filled[:, None]] = 0
    return rows, owner, (rows > 32).sum(axis=1)


@dataclass
class ByteNet:
    """Weights: embedding (256, e), a filter bank (width * e, f) per width, and the last layer."""

    labels: list[str]
    embedding: np.ndarray
    filters: list[np.ndarray]
    biases: list[np.ndarray]
    last: np.ndarray
    last_bias: np.ndarray

    @classmethod
    def new(cls, labels: list[str], seed: int = 5) -> ByteNet:
        rng = np.random.default_rng(seed)
        scaled = lambda *shape: rng.normal(0, (2 / shape[0]) ** 0.5, shape).astype(np.float32)
        return cls(
            labels,
            rng.normal(0, 0.5, (256, EMBEDDED)).astype(np.float32),
            [scaled(w * EMBEDDED, FILTERS) for w in WIDTHS],
            [np.zeros(FILTERS, np.float32) for _ in WIDTHS],
            scaled(FILTERS * len(WIDTHS), len(labels)),
            np.zeros(len(labels), np.float32),
        )

    def weights(self) -> list[np.ndarray]:
        return [self.embedding, *self.filters, *self.biases, self.last, self.last_bias]

    def step(self, rows: np.ndarray, wanted: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Loss of a batch and the gradient of every weight."""
        n = len(rows)
        embedded = self.embedding[rows]
        pooled, places = [], []
        for bank, bias, width in zip(self.filters, self.biases, WIDTHS, strict=True):
            spans = np.lib.stride_tricks.sliding_window_view(embedded.reshape(n, -1), width * EMBEDDED, axis=1)[:, ::EMBEDDED]
            answers = spans.reshape(-1, width * EMBEDDED) @ bank
            answers = answers.reshape(n, -1, FILTERS) + bias
            place = answers.argmax(axis=1)
            places.append(place)
            pooled.append(np.take_along_axis(answers, place[:, None], axis=1)[:, 0])
        before = np.concatenate(pooled, axis=1)
        hidden = np.maximum(before, 0)
        chances = softmax(hidden @ self.last + self.last_bias)
        loss = float(-np.log(np.maximum(chances[np.arange(n), wanted], 1e-9)).mean())
        error = chances
        error[np.arange(n), wanted] -= 1
        error /= n
        to_hidden = (error @ self.last.T) * (before > 0)
        to_embedding = np.zeros_like(self.embedding)
        banks, biases = [], []
        for k, (bank, place, width) in enumerate(zip(self.filters, places, WIDTHS, strict=True)):
            grad = to_hidden[:, k * FILTERS:(k + 1) * FILTERS]
            at = place[:, :, None] + np.arange(width)
            seen = np.take_along_axis(rows, at.reshape(n, -1), axis=1).reshape(n, FILTERS, width)
            vectors = self.embedding[seen].reshape(n, FILTERS, width * EMBEDDED)
            banks.append(np.einsum("nfd,nf->df", vectors, grad))
            biases.append(grad.sum(axis=0))
            back = (grad[:, :, None] * bank.T[None]).reshape(-1, EMBEDDED)
            np.add.at(to_embedding, seen.reshape(-1), back)
        return loss, [to_embedding, *banks, *biases, hidden.T @ error, error.sum(axis=0)]

    def fit(self, rows: np.ndarray, wanted: np.ndarray, epochs: int = 6, batch: int = 64, rate: float = 0.01, seed: int = 6) -> list[float]:
        """Adam over shuffled batches; losses of the epochs."""
        rng = np.random.default_rng(seed)
        first = [np.zeros_like(w) for w in self.weights()]
        second = [np.zeros_like(w) for w in self.weights()]
        losses, t = [], 0
        for epoch in range(epochs):
            total = 0.0
            speed = rate * (1 - epoch / epochs)
            order = rng.permutation(len(rows))
            for i in range(0, len(order), batch):
                pick = order[i:i + batch]
                loss, grads = self.step(rows[pick], wanted[pick])
                total += loss * len(pick)
                t += 1
                for w, g, a, b in zip(self.weights(), grads, first, second, strict=True):
                    a += 0.1 * (g - a)
                    b += 0.01 * (g * g - b)
                    w -= speed * (a / (1 - 0.9**t)) / (np.sqrt(b / (1 - 0.99**t)) + 1e-7)
            losses.append(total / max(1, len(rows)))
        return losses

    def tables(self) -> list[list[np.ndarray]]:
        """Answers of each filter bank to one byte or two neighbouring bytes.

        A filter's answer is a sum over its places, so two places make a table of 65,536 rows and
        no embedding or product is left to do per byte.
        """
        out = []
        for bank, width in zip(self.filters, WIDTHS, strict=True):
            places = [self.embedding @ bank[j * EMBEDDED:(j + 1) * EMBEDDED] for j in range(width)]
            pairs = [(places[j][:, None] + places[j + 1][None]).reshape(65536, FILTERS) for j in range(0, width - 1, 2)]
            out.append([*pairs, *([places[-1]] if width % 2 else [])])
        return out

    def chances(self, rows: np.ndarray, tables: list[list[np.ndarray]] | None = None) -> np.ndarray:
        """Chance of each label for each window."""
        tables = tables or self.tables()
        out = np.zeros((len(rows), len(self.labels)), np.float32)
        for i in range(0, len(rows), 64):
            part = rows[i:i + 64].astype(np.intp)
            pairs = part[:, :-1] * 256 + part[:, 1:]
            pooled = []
            for own, bias, width in zip(tables, self.biases, WIDTHS, strict=True):
                n = LENGTH - width + 1
                answers = None
                for j, table in enumerate(own):
                    index = pairs[:, 2 * j:2 * j + n] if len(table) == 65536 else part[:, 2 * j:2 * j + n]
                    found = table.take(index, axis=0)
                    answers = found if answers is None else np.add(answers, found, out=answers)
                pooled.append(answers.max(axis=1) + bias)
            out[i:i + 64] = softmax(np.maximum(np.concatenate(pooled, axis=1), 0) @ self.last + self.last_bias)
        return out


def softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=1, keepdims=True))
    return x / x.sum(axis=1, keepdims=True)


def remainder(modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; null for a null id."""
    return F.crc32(F.col("doc_id").cast("string")) % modulus


def training_windows(docs: DataFrame, learn: Column, per_label: int, per_text: int) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Windows and labels of a bounded sample: about ``per_label`` texts of each label that ``learn`` admits.

    Rows are taken by a hash of id and text, so reruns agree; the driver gets at most
    ``2 * per_label * per_text`` windows a label.
    """
    rows = id_and_text(docs, F.col("lang").cast("string").alias("lang")).where(learn & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    labels = sorted(counts)
    if not labels:
        return np.zeros((0, LENGTH), np.uint8), np.zeros(0, np.int64), []
    key = F.pmod(F.xxhash64("doc_id", F.lit(71)), F.lit(1_000_000)) / 1e6
    share = F.create_map(*[x for c in labels for x in (F.lit(c), F.lit(min(1.0, 1.5 * per_label / counts[c])))])
    chosen = rows.withColumn("key", key).where(F.col("key") < share[F.col("lang")])

    def compute(texts: list[bytes | None]) -> list:
        found, owner, letters = cut(texts)
        out: list[list[bytes]] = [[] for _ in texts]
        for i in np.flatnonzero(letters > 0):
            out[owner[i]].append(found[i].tobytes())
        # Evenly spread over the text.
        return [[[x[j * len(x) // per_text] for j in range(per_text)] if len(x) > per_text else x for x in out]]

    got = map_texts(chosen, compute, "windows array<binary>", keep=("doc_id", "lang", "key")).toPandas()
    got["key"] = got["key"].astype(float)
    got = got.sort_values(["key", "doc_id"]).groupby("lang").head(2 * per_label)
    pairs = [(w, labels.index(c)) for c, ws in zip(got["lang"], got["windows"], strict=True) for w in ws]
    pairs.sort()
    rows_out = np.frombuffer(b"".join(w for w, _ in pairs), np.uint8).reshape(-1, LENGTH)
    return rows_out, np.array([c for _, c in pairs], np.int64), labels


def train(docs: DataFrame, learn: Column, per_label: int = 240, per_text: int = 4) -> ByteNet | None:
    """A network fitted on a bounded sample; None if no row is labelled."""
    rows, wanted, labels = training_windows(docs, learn, per_label, per_text)
    if not len(rows):
        return None
    net = ByteNet.new(labels)
    net.fit(rows, wanted)
    return net


def identify(docs: DataFrame, net: ByteNet | None, *keep: str) -> DataFrame:
    """``doc_id, lang_pred, score`` of every text.

    ``lang_pred`` is ``und`` with score 0 where the text is null, empty or without a letter, or
    where nothing could be learned; else the label with the highest mean chance, which is the
    score.  Ties go to the label that sorts first.  Rows that repeat give a row each; of other
    columns only ``keep`` are read.
    """

    def compute(texts: list[bytes | None]) -> list:
        known = [net is not None and t is not None and has_letter(t.decode("utf-8", "replace")) for t in texts]
        if net is None:
            return [[UNKNOWN] * len(texts), [0.0] * len(texts)]
        rows, owner, letters = cut(texts)
        weight = letters.astype(np.float64) + 1e-6
        sums = np.zeros((len(texts), len(net.labels)))
        if not tables:
            tables.extend(net.tables())  # once a task, as they are larger than the network
        np.add.at(sums, owner, net.chances(rows, tables) * weight[:, None])
        sums /= np.bincount(owner, weight, len(texts))[:, None]
        best = sums.argmax(axis=1)
        return [
            [net.labels[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)],
            [float(min(1.0, s)) if k else 0.0 for s, k in zip(sums.max(axis=1), known, strict=True)],
        ]

    tables: list[list[np.ndarray]] = []
    return map_texts(id_and_text(docs, *keep), compute, "lang_pred string, score double", keep=("doc_id", *keep))
