"""Toxicity scores by a factorization machine over hashed terms.

Terms of a text are its lower-cased words, their beginnings of 4 to 6 letters, and its length
class; each is hashed into ``CELLS`` cells and enters with log(1 + count). Beside a weight, every
cell has a short latent vector, so that pairs of terms (an insult with the mention of a group, a
stem with the length of the text) add their inner product, which additive weights cannot.

Training reads a sample of labelled rows: about ``per_label`` of either label, all if there are
fewer, chosen by a hash of the key. Cells are selected by how far their document frequencies
differ between the labels, with the most frequent ones; the machine is then fitted by AdaGrad in numpy. A fifth of the sample
is set aside; scale and offset of the final logit are fitted on it, each label weighted to its
share among all labelled rows. Null and empty texts have no terms and
get the score of the intercept. Without two labels every text gets the share of label 1 (0 if
there are none). Repeated rows are scored each by itself; whole texts are read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sembra.llm.common import bounded_sample, keep_rows, map_columns

CELLS = 1 << 20
WORD = re.compile(r"[^\W\d_]+")
CACHE_WORDS = 200_000


@dataclass(frozen=True)
class ToxicityModel:
    intercept: float
    cells: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    latent: np.ndarray = field(default_factory=lambda: np.zeros((0, 1)))


def cell(term: str) -> int:
    return zlib.crc32(term.encode()) % CELLS


def word_cells(word: str) -> list[int]:
    return [cell("w" + word), *(cell(f"{n}{word[:n]}") for n in (4, 5, 6) if len(word) >= n)]


def length_cell(words: int) -> int:
    return cell(f"#{words.bit_length()}")


def term_counts(text: str | None, known: dict | None = None, cache: dict | None = None) -> dict[int, int]:
    """Counts of the text's cells; with ``known``, only of its keys, under its values."""
    words = WORD.findall((text or "").lower())
    counts: dict[int, int] = {}
    if not words:
        return counts
    cache = {} if cache is None else cache
    if len(cache) > CACHE_WORDS:
        cache.clear()
    for word, n in Counter(words).items():
        cells = cache.get(word)
        if cells is None:
            cells = word_cells(word)
            cells = cache[word] = cells if known is None else [known[c] for c in cells if c in known]
        for c in cells:
            counts[c] = counts.get(c, 0) + n
    c = length_cell(len(words))
    if known is None or c in known:
        counts[c if known is None else known[c]] = 1
    return counts


def training_features(sample: DataFrame, text: str, label: str) -> list:
    def make():
        def run(texts, labels, totals):
            out = []
            for value, toxic, total in zip(texts, labels, totals):
                counts = term_counts(value)
                cells = np.fromiter(counts.keys(), "<i4", len(counts))
                values = np.fromiter(counts.values(), "<i4", len(counts))
                out.append((toxic, total, cells.tobytes(), values.tobytes()))
            return zip(*out) if out else [[]] * 4

        return run

    ddl = "toxic int, total long, cells binary, counts binary"
    rows = map_columns(sample.select(text, label, "label_rows"), ddl, make).collect()
    return sorted((r.toxic, r.total, bytes(r.cells), bytes(r.counts)) for r in rows)


def select_cells(features: list, labels: np.ndarray, least: int, most: int, common: int) -> np.ndarray:
    """Cells whose share of toxic documents is farthest from their share of the others, and the
    ``common`` most frequent ones, which may matter in pairs only."""
    found = []
    for label in (0, 1):
        of = [c for (c, _), y in zip(features, labels) if y == label]
        found.append(np.bincount(np.concatenate(of), minlength=CELLS) if of else np.zeros(CELLS))
    clean, toxic = found
    n0, n1 = max(1, (labels == 0).sum()), max(1, (labels == 1).sum())
    share = (clean + toxic + 1) / (n0 + n1 + 2)
    far = np.abs(toxic / n1 - clean / n0) / np.sqrt(share * (1 - share) * (1 / n0 + 1 / n1))
    far[(clean + toxic) < least] = 0
    chosen = np.argsort(-far, kind="stable")[:most]
    often = np.argsort(-(clean + toxic), kind="stable")[:common]
    often = often[((clean + toxic)[often] >= least) & (share[often] < 0.9)]
    return np.union1d(chosen[far[chosen] > 2.0], often)


def logit(at: np.ndarray, x: np.ndarray, w: np.ndarray, v: np.ndarray, b: float) -> float:
    """Intercept, weights and pairwise interactions of the cells ``at`` with inputs ``x``."""
    inside = v[at]
    s = x @ inside
    return b + float(x @ w[at] + 0.5 * (s @ s - ((inside * inside) * (x * x)[:, None]).sum()))


def platt(z: np.ndarray, y: np.ndarray, weight: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """(scale, offset) of the logits by weighted logistic regression on Platt's softened targets."""
    n1, n0 = (y == 1).sum(), (y == 0).sum()
    target = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    inputs = np.stack([z, np.ones(len(z))], 1)
    found = np.array([1.0, 0.0])
    weight = weight / weight.sum() * len(z)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(inputs @ found, -30, 30)))
        ridge = np.diag([1e-2, 1e-2])
        slope = inputs.T @ (weight * (p - target)) + ridge @ (found - [1.0, 0.0])
        curve = (inputs * (weight * p * (1 - p))[:, None]).T @ inputs + ridge
        move = np.linalg.solve(curve, slope)
        found = found - move / max(1.0, float(np.abs(move).max()))
        found[0] = max(0.05, found[0])
    return float(found[0]), float(found[1])


def fit_toxicity(
    labelled: DataFrame, docs: DataFrame | None = None, text: str = "text", label: str = "toxic", key: str = "doc_id",
    per_label: int = 2_500, most_cells: int = 3_000, common_cells: int = 200, rank: int = 4, epochs: int = 30, rate: float = 0.2, l2: float = 2e-3,
) -> ToxicityModel:
    """Train on rows of ``labelled`` with a label (0 or 1).

    Their texts are in ``labelled``, or in ``docs`` under the same key: then the labels are sampled
    first, and the sample, of about ``2 * per_label`` rows, goes to the documents; no text is moved.
    """
    known = [key, F.col(label).cast("int").alias(label), *([] if docs is not None else [text])]
    sample = bounded_sample(labelled.where(F.col(label).isin(0, 1)).select(*known), label, key, per_label)
    if docs is not None:
        sample = docs.select(key, text).join(F.broadcast(sample), key)
    rows = training_features(sample, text, label)
    totals = {toxic: total for toxic, total, _, _ in rows}
    share = totals.get(1, 0) / max(1, sum(totals.values()))
    prior = float(np.log(max(share, 1e-6) / max(1 - share, 1e-6)))
    if len(totals) < 2:
        return ToxicityModel(prior)
    labels = np.array([r[0] for r in rows])
    features = [(np.frombuffer(r[2], "<i4"), np.frombuffer(r[3], "<i4")) for r in rows]
    cells = select_cells(features, labels, 3, most_cells, common_cells)
    inputs = []
    for found, counts in features:
        at = np.searchsorted(cells, found)
        inside = (at < len(cells)) & (cells[np.minimum(at, max(0, len(cells) - 1))] == found) if len(cells) else at < 0
        inputs.append((at[inside], np.log1p(counts[inside])))
    draw = np.random.default_rng(5)
    order = draw.permutation(len(rows))
    aside, fitted = (order[::5], np.delete(order, np.s_[::5])) if len(rows) >= 50 else (order, order)
    w, v, b = np.zeros(len(cells)), draw.normal(scale=0.05, size=(len(cells), rank)), 0.0
    gw, gv = np.full(len(cells), 1e-2), np.full((len(cells), rank), 1e-2)
    drawn = np.bincount(labels, minlength=2)
    balance = len(labels) / (2 * np.maximum(1, drawn))
    for _ in range(epochs):
        for i in draw.permutation(fitted):
            at, x = inputs[i]
            va = v[at]
            s = x @ va
            z = logit(at, x, w, v, b)
            g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[i]) * balance[labels[i]]
            b -= 0.02 * g
            dw = g * x + l2 * w[at]
            dv = g * (x[:, None] * s - (x * x)[:, None] * va) + l2 * va
            gw[at] += dw * dw
            gv[at] += dv * dv
            w[at] -= rate * dw / np.sqrt(gw[at])
            v[at] -= 0.3 * rate * dv / np.sqrt(gv[at])
    logits = np.array([logit(*inputs[i], w, v, b) for i in aside])
    weights = np.array([totals[0], totals[1]]) / np.maximum(1, np.bincount(labels[aside], minlength=2))
    scale, offset = platt(logits, labels[aside], weights[labels[aside]])
    return ToxicityModel(scale * float(b) + offset, cells.astype(np.int64), scale * w, np.sqrt(scale) * v)


def scorer(model: ToxicityModel):
    """text -> probability of label 1; keeps a bounded cache of words."""
    known = {int(c): i for i, c in enumerate(model.cells)}
    cache: dict = {}

    def score(text: str | None) -> float:
        counts = term_counts(text, known, cache)
        at = np.fromiter(counts.keys(), np.int64, len(counts))
        x = np.log1p(np.fromiter(counts.values(), float, len(counts)))
        z = logit(at, x, model.weights, model.latent, model.intercept)
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))

    return score


def score_toxicity(docs: DataFrame, model: ToxicityModel, text: str = "text", key: str = "doc_id", threshold: float = 0.3) -> DataFrame:
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


def keep_clean(docs: DataFrame, model: ToxicityModel, text: str = "text", threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` that score below the threshold, with all their columns."""

    def make():
        score = scorer(model)
        return lambda value: score(value) < threshold

    return keep_rows(docs, text, make)
