"""Language identification: averaged hashed subword embeddings under a linear softmax.

A text is lower-cased, its ASCII non-letters become spaces, and the 2- to 4-byte subwords of the
result are hashed into ``CELLS`` cells. The mean of their embeddings is the input of a softmax.
Both layers are trained together by stochastic gradient descent in numpy, every step scaled by the
gradients that its row has had, with weight decay: steps shrink and weights stay bounded. The sample
holds about ``per_language`` texts a language, all languages together about ``most_rows``; of each text
it takes the whole and some short windows (so that short texts are predicted too), which follow from
the text alone, so the model does not depend on how rows lie in partitions.

A fifth of the sampled texts is set aside. They give the softmax temperature, which makes scores
probabilities, and two bounds that reject one in a hundred right answers each: the least score,
and the least share of subwords that training has seen (a text in an unknown script has few).

Null texts and texts without a letter get ``und`` with score 0. Without any labelled row every
text gets ``und``. Of equal scores the first language in code-point order wins. Repeated rows are
predicted each by itself, rows sharing an id too; whole texts are always read, extra columns never.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sembra.llm.common import map_columns
from sembra.session import lookup_join

BITS = 16
CELLS = 1 << BITS
LETTER = re.compile(r"[^\W\d_]")
#: ASCII letters and all bytes above 127 stay, anything else becomes a space.
KEEP = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))
UNDETERMINED = "und"
SLICE_BYTES = 1 << 20


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    embeddings: np.ndarray  # CELLS x dimensions
    output: np.ndarray  # dimensions x languages
    bias: np.ndarray
    temperature: float
    reject_below: float
    seen: np.ndarray  # CELLS booleans
    least_seen: float

    def judge(self, x: np.ndarray, coverage: float) -> tuple[int, float, bool]:
        """(number of the language, its probability, whether it is rejected) for a mean embedding."""
        z = (x @ self.output + self.bias) / self.temperature
        p = np.exp(z - z.max())
        best = int(p.argmax())
        score = float(p[best] / p.sum())
        return best, score, bool(score < self.reject_below or coverage < self.least_seen)


def subword_cells(text: str):
    """Hash cells of all 2-, 3- and 4-byte subwords of the whole text, some at a time."""
    words = text.lower().encode("utf-8", "surrogatepass").translate(KEEP).split()
    whole = np.frombuffer(b" " + b" ".join(words) + b" ", np.uint8)
    for start in range(0, len(whole), SLICE_BYTES):
        # Slices overlap by the longest subword less one byte.
        b = whole[start : start + SLICE_BYTES + 3].astype(np.uint32)
        gram = b
        for n in (2, 3, 4):
            gram = gram[:-1] | (b[n - 1 :] << np.uint32(8 * (n - 1)))
            mixed = (gram[:SLICE_BYTES] + np.uint32(n * 40503)) * np.uint32(2654435761)
            yield (mixed ^ (mixed >> np.uint32(15))) * np.uint32(2246822519) >> np.uint32(32 - BITS)


def cell_counts(text: str) -> np.ndarray:
    counts = np.zeros(CELLS, np.int64)
    for cells in subword_cells(text):
        counts += np.bincount(cells, minlength=CELLS)
    return counts


def windows(text: str) -> list[str]:
    """The whole text and three short windows of its words, drawn by a hash of the text."""
    words = text.split()
    draw = np.random.default_rng(zlib.crc32(text.encode("utf-8", "surrogatepass")))
    found = [text]
    for _ in range(3 if len(words) > 3 else 0):
        size = int(draw.integers(1, 9))
        start = int(draw.integers(0, max(1, len(words) - size)))
        found.append(" ".join(words[start : start + size]))
    return [w for w in found if LETTER.search(w)]


def language_sample(labelled: DataFrame, lang: str, key: str, per_language: int, most_rows: int) -> DataFrame:
    """About ``per_language`` rows of each language (all, if fewer), fewer where all languages together
    would be more than about ``most_rows``; chosen by a hash of ``key``, at rates from exact counts."""
    counts = labelled.groupBy(lang).agg(F.count(F.lit(1)).alias("label_rows"))
    rows = min(float(per_language), most_rows / max(1, counts.count()))
    draw = F.pmod(F.xxhash64(F.lit("sample"), F.col(key)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return lookup_join(labelled, counts, [lang], spread_by=key).where(draw < F.lit(rows) / F.col("label_rows"))


def training_features(sample: DataFrame, text: str, lang: str) -> list:
    """(language, number of the text, cells, shares) of the sampled texts and their windows, made in tasks."""

    def make():
        def run(texts, langs):
            out = []
            for value, label in zip(texts, langs):
                for window in windows(value):
                    counts = cell_counts(window)
                    cells = np.flatnonzero(counts)
                    shares = (counts[cells] / counts.sum()).astype("<f4")
                    out.append((label, zlib.crc32(value.encode("utf-8", "surrogatepass")), cells.astype("<u2").tobytes(), shares.tobytes()))
            return zip(*out) if out else [[]] * 4

        return run

    rows = map_columns(sample.select(text, lang), "lang string, of long, cells binary, shares binary", make).collect()
    return sorted((r.lang, r["of"], bytes(r.cells), bytes(r.shares)) for r in rows)


def descend(
    features: list, labels: np.ndarray, rows: np.ndarray, weight: np.ndarray, draw: np.random.Generator,
    dimensions: int, epochs: int, rate: float, decay: float,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Embeddings, output layer and bias after ``epochs`` passes over ``rows`` in random order."""
    n = len(weight)
    embeddings = (draw.normal(size=(CELLS, dimensions)) * 0.01).astype(np.float32)
    output, bias = (draw.normal(size=(dimensions, n)) * 0.1).astype(np.float32), np.zeros(n, np.float32)
    # Squared gradients so far, by which steps are divided.
    had, had_output = np.full(CELLS, 1e-8, np.float32), np.full((dimensions, n), 1e-4, np.float32)
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        for i in draw.permutation(rows):
            cells, shares = features[i]
            mine = embeddings[cells]
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
            had[cells] += shares * shares * float(back @ back) / dimensions
            embeddings[cells] -= step * (np.outer(shares / np.sqrt(had[cells]), back) + decay * mine)
    return embeddings, output, bias


def fit_language_model(
    labelled: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id",
    per_language: int = 600, most_rows: int = 12_000, dimensions: int = 16, epochs: int = 5, rate: float = 0.1, decay: float = 1e-3,
) -> LanguageModel | None:
    """Train on labelled rows; null labels and texts without letters take no part."""
    usable = labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(key, text, lang)
    rows = training_features(language_sample(usable, lang, key, per_language, most_rows), text, lang)
    if not rows:
        return None
    languages = tuple(sorted({r[0] for r in rows}))
    number = {name: i for i, name in enumerate(languages)}
    labels = np.array([number[r[0]] for r in rows])
    features = [(np.frombuffer(r[2], "<u2").astype(np.int64), np.frombuffer(r[3], "<f4")) for r in rows]
    draw = np.random.default_rng(11)
    # A text and its windows, and equal texts, stay on one side.
    held = np.array([r[1] % 5 == 0 for r in rows])
    aside, fitted = np.flatnonzero(held), np.flatnonzero(~held)
    if not len(aside) or not len(fitted):
        aside = fitted = np.arange(len(rows))
    weight = len(fitted) / (len(languages) * np.maximum(1, np.bincount(labels[fitted], minlength=len(languages))))
    embeddings, output, bias = descend(features, labels, fitted, np.minimum(weight, 5.0), draw, dimensions, epochs, rate, decay)
    seen = np.zeros(CELLS, bool)
    for i in fitted:
        seen[features[i][0]] = True
    logits = np.array([features[i][1] @ embeddings[features[i][0]] @ output + bias for i in aside])
    covered = np.array([features[i][1] @ seen[features[i][0]] for i in aside])
    truth = labels[aside]

    # One more row of unknown language keeps a faultless set from asking for full certainty.
    unknown = 1 / (len(aside) + 1)

    def loss(t: float) -> float:
        z = logits / t
        z = z - z.max(1, keepdims=True)
        log_p = z - np.log(np.exp(z).sum(1, keepdims=True))
        return -float(((1 - unknown) * log_p[np.arange(len(z)), truth] + unknown * log_p.mean(1)).mean())

    temperature = min((1.1**k for k in range(-40, 41)), key=loss)
    z = np.exp(logits / temperature - (logits / temperature).max(1, keepdims=True))
    confidence = (z / z.sum(1, keepdims=True)).max(1)
    right = logits.argmax(1) == truth
    bound = lambda values: float(np.quantile(values[right], 0.01)) if right.any() else 0.0
    return LanguageModel(languages, embeddings, output, bias, temperature, bound(confidence), seen, bound(covered))


def predict_languages(docs: DataFrame, model: LanguageModel | None, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key``, lang_pred, score (probability of it) and rejected, one row per row of ``docs``."""
    selected = docs.select(key, text)
    kind = selected.schema[0].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        model = shared.value

        def predict(value):
            if model is None or value is None or not LETTER.search(value):
                return UNDETERMINED, 0.0, True
            total, seen, n = np.zeros(model.embeddings.shape[1]), 0, 0
            for cells in subword_cells(value):
                total += model.embeddings[cells].sum(0, dtype=np.float64)
                seen += int(model.seen[cells].sum())
                n += len(cells)
            best, score, rejected = model.judge(total / n, seen / n)
            return model.languages[best], score, rejected

        def run(keys, texts):
            return keys, *(zip(*map(predict, texts)) if texts else [[]] * 3)

        return run

    return map_columns(selected, f"`{key}` {kind}, lang_pred string, score double, rejected boolean", make)
