"""Quality scores by supervised subword embeddings: averaged hashed vectors under a softmax.

A text's units are its words (runs without ASCII white space, as written), its pairs of adjacent
words (two equal ones share one cell, so that mere repetition is seen whatever the word), and the
character n-grams of 3 to 5 bytes of the text, white space being one space. Every unit is hashed into one of
``CELLS`` cells; the mean of the cells' vectors, counted as often as they occur, is the input of a
softmax over the two labels.

Vectors and softmax are trained together by stochastic gradient descent in numpy (steps are scaled
per cell by the gradients that it has had, as frequent cells would else drown the others) on a
sample of labelled rows: about ``per_label`` of either label, all if there are fewer, chosen by a
hash of the key. A sampled row sends at most ``CELLS`` counts to the driver, so the sample has a
fixed size whatever the input. A fifth of it is set aside and calibrates scale and offset of the
logit, each label weighted to its share among all labelled rows.

Whole texts are read. Null and empty texts have no units: they get the score of the intercept.
Without two labels every text gets the share of label 1 (0 if there are none). Equal texts get equal
scores, repeated rows and ids are scored each by itself, extra columns are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sembra.llm.common import bounded_sample, map_columns
from sembra.llm.toxicity_fm import platt

BITS = 15
CELLS = 1 << BITS
CACHE_WORDS = 300_000
SLICE_BYTES = 1 << 18
MIX = np.uint64(0x9E3779B97F4A7C15)
#: Salts keep words, pairs and n-grams of each length apart.
WORD, PAIR, GRAM = 1, 2, 3
#: The cell of two equal words in a row.
AGAIN = 0


def to_cells(keys: np.ndarray, salt: int) -> np.ndarray:
    mixed = (keys ^ np.uint64(salt * 0xC2B2AE3D27D4EB4F & 0xFFFFFFFFFFFFFFFF)) * MIX
    mixed ^= mixed >> np.uint64(31)
    return ((mixed * MIX) >> np.uint64(64 - BITS)).astype(np.int64)


class Units:
    """The cells of a text's units, one array after the other; words are hashed once while cached."""

    def __init__(self):
        self.cache: dict[bytes, int] = {}

    def hashes(self, words: list[bytes]) -> np.ndarray:
        if len(self.cache) > CACHE_WORDS:
            self.cache.clear()
        cache, found = self.cache, []
        for word in words:
            value = cache.get(word)
            if value is None:
                value = cache[word] = xxhash.xxh3_64_intdigest(word)
            found.append(value)
        return np.array(found, np.uint64)

    def __call__(self, text: str | None):
        words = (text or "").encode("utf-8", "surrogatepass").split()
        if not words:
            return
        h = self.hashes(words)
        yield to_cells(h, WORD)
        pairs = to_cells(h[:-1] * MIX + h[1:], PAIR)
        yield np.where(h[:-1] == h[1:], AGAIN, pairs)
        joined = np.frombuffer(b" " + b" ".join(words) + b" ", np.uint8)
        for start in range(0, len(joined), SLICE_BYTES):
            # Slices overlap by the longest n-gram less one byte, so each n-gram is in one slice.
            b = joined[start : start + SLICE_BYTES + 4].astype(np.uint64)
            gram = b
            for n in range(2, 6):
                gram = gram[:-1] | (b[n - 1 :] << np.uint64(8 * (n - 1)))
                if n >= 3:
                    yield to_cells(gram[:SLICE_BYTES], GRAM + n)


@dataclass(frozen=True)
class QualityModel:
    """``vectors @ (output of label 1 - output of label 0)``, one number a cell: the mean of these is
    the logit that the mean vector gives."""

    intercept: float
    slopes: np.ndarray = field(default_factory=lambda: np.zeros(CELLS))


def training_features(sample: DataFrame, text: str, label: str) -> list:
    """(label, rows of the label in all, cells, counts) of the sampled texts, made in tasks."""

    def make():
        units = Units()

        def run(texts, labels, totals):
            out = []
            for value, good, total in zip(texts, labels, totals):
                counts = np.zeros(CELLS, np.int64)
                for cells in units(value):
                    counts += np.bincount(cells, minlength=CELLS)
                at = np.flatnonzero(counts)
                out.append((good, total, at.astype("<u2").tobytes(), counts[at].astype("<f4").tobytes()))
            return zip(*out) if out else [[]] * 4

        return run

    rows = map_columns(sample.select(text, label, "label_rows"), "good int, total long, cells binary, counts binary", make)
    return sorted((r.good, r.total, bytes(r.cells), bytes(r.counts)) for r in rows.collect())


def descend(
    inputs: list, labels: np.ndarray, rows: np.ndarray, weight: np.ndarray, draw: np.random.Generator,
    dimensions: int, epochs: int, rate: float, decay: float,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Vectors, output layer and bias after ``epochs`` passes over ``rows`` in random order."""
    vectors = (draw.normal(size=(CELLS, dimensions)) * 0.1).astype(np.float32)
    output, bias = np.zeros((dimensions, 2), np.float32), np.zeros(2, np.float32)
    # Squared gradients so far, by which steps are divided.
    had_vectors, had_output = np.full(CELLS, 1e-8, np.float32), np.full((dimensions, 2), 1e-4, np.float32)
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        for i in draw.permutation(rows):
            cells, shares = inputs[i]
            mine = vectors[cells]
            x = shares @ mine
            z = x @ output + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[labels[i]] -= 1
            p *= weight[labels[i]]
            back = output @ p
            slope = np.outer(x, p)
            had_output += slope * slope
            output -= step * (slope / np.sqrt(had_output) + decay * output)
            bias -= 0.05 * step * p
            if len(cells):
                had_vectors[cells] += shares * shares * float(back @ back) / dimensions
                vectors[cells] -= step * (np.outer(shares / np.sqrt(had_vectors[cells]), back) + decay * mine)
    return vectors, output, bias


def fit_quality(
    labelled: DataFrame, docs: DataFrame | None = None, text: str = "text", label: str = "quality", key: str = "doc_id",
    per_label: int = 1_500, dimensions: int = 8, epochs: int = 6, rate: float = 0.1, decay: float = 1e-3,
) -> QualityModel:
    """Train on rows of ``labelled`` with a label (0 or 1).

    Their texts are in ``labelled``, or in ``docs`` under the same key: then the labels are sampled
    first, and the sample, of about ``2 * per_label`` rows, goes to the documents; no text is moved.
    """
    known = [key, F.col(label).cast("int").alias(label), *([] if docs is not None else [text])]
    sample = bounded_sample(labelled.where(F.col(label).isin(0, 1)).select(*known), label, key, per_label)
    if docs is not None:
        sample = docs.select(key, text).join(F.broadcast(sample), key)
    rows = training_features(sample, text, label)
    totals = {good: total for good, total, _, _ in rows}
    share = totals.get(1, 0) / max(1, sum(totals.values()))
    if len(totals) < 2:
        return QualityModel(float(np.log(max(share, 1e-6) / max(1 - share, 1e-6))))
    labels, inputs = np.array([r[0] for r in rows]), []
    for _, _, cells, counts in rows:
        n = np.frombuffer(counts, "<f4")
        inputs.append((np.frombuffer(cells, "<u2").astype(np.int64), n / max(1.0, float(n.sum()))))
    draw = np.random.default_rng(23)
    order = draw.permutation(len(rows))
    aside, fitted = (order[::5], np.delete(order, np.s_[::5])) if len(rows) >= 50 else (order, order)
    balance = len(labels) / (2 * np.maximum(1, np.bincount(labels, minlength=2)))
    vectors, output, bias = descend(inputs, labels, fitted, balance, draw, dimensions, epochs, rate, decay)
    slopes, offset = (vectors @ (output[:, 1] - output[:, 0])).astype(np.float64), float(bias[1] - bias[0])
    logits = np.array([inputs[i][1] @ slopes[inputs[i][0]] + offset for i in aside])
    weights = np.array([totals[0], totals[1]]) / np.maximum(1, np.bincount(labels[aside], minlength=2))
    scale, shift = platt(logits, labels[aside], weights[labels[aside]])
    return QualityModel(scale * offset + shift, scale * slopes)


def scorer(model: QualityModel):
    """text -> probability of label 1; keeps a bounded cache of words."""
    units = Units()

    def score(text: str | None) -> float:
        total, n = 0.0, 0
        for cells in units(text):
            total += float(model.slopes[cells].sum())
            n += len(cells)
        z = model.intercept + total / max(1, n)
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))

    return score


def score_quality(docs: DataFrame, model: QualityModel, text: str = "text", key: str = "doc_id", threshold: float = 0.3) -> DataFrame:
    """``key``, score and predicted, one row per row of ``docs``."""
    selected = docs.select(key, text)
    kind = selected.schema[0].dataType.simpleString()

    def make():
        score = scorer(model)

        def run(keys, texts):
            scores = [score(t) for t in texts]
            return keys, scores, [int(s >= threshold) for s in scores]

        return run

    return map_columns(selected, f"`{key}` {kind}, score double, predicted int", make)
