"""URL verdicts: host and path rules first, else logistic regression on hashed character n-grams.

A url is split by the contract of ``split_url``. The longest rule (host plus path, in characters)
that fits decides; the rules of a host hold for all its subdomains. Where no rule fits, the
n-grams of host and path are hashed into ``UrlModel.bits`` bits and a logistic regression, fitted
from the small labelled table below (or one of the caller's), decides at probability one half.

Null urls and urls without ``://`` have an empty host and path and no n-grams: the verdict is
then that of the model's intercept, which the fit holds below one half (allow). Of rules that fit
with equal length the last in code-point order of host and path counts. Urls of any length are read
whole, in time linear in their length; repeated rows are judged each by itself; extra columns are
not looked at; an empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame

from sembra.llm.common import map_columns

URL = re.compile(r"://([^/?#]*)([^?#]*)", re.S)
ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

#: (host, path, verdict)
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
#: Names of the labelled table; each stands on several hosts and paths.
BLOCKED_NAMES = (
    "casino-win", "online-casino", "casino-royal", "free-bets", "best-bets", "sports-bets", "poker-room",
    "slots-jackpot", "lottery-win", "adult-x", "adult-video", "xxx-tube", "porn-hub", "sex-cams", "hot-singles",
    "cheap-pills", "buy-viagra", "pills-online", "diet-pills", "spam-farm", "link-farm", "seo-spam", "ads-track",
    "ad-server", "click-ads", "track-pixel", "popup-ads", "payday-loan", "quick-cash", "warez-crack", "torrent-free",
    "phish-login", "fake-rolex", "replica-watch", "malware-drop", "get-rich-quick",
)
ALLOWED_NAMES = (
    "library", "university", "science", "weather", "museum", "history", "garden", "kitchen", "recipes", "travel",
    "school", "health", "city-news", "daily-news", "sports", "football", "music", "theatre", "docs", "wiki",
    "python", "research", "nature", "physics", "chemistry", "maths", "books", "photos", "maps", "forum",
    "hiking", "cycling", "film-review", "art", "hotel", "restaurant", "hospital", "church", "parliament", "airport",
    "railway", "college", "insurance", "newspaper", "magazine", "orchestra", "stadium", "gallery", "conference",
    "foundation", "association", "community", "government", "ministry", "institute", "academy", "archive", "journal",
)


@dataclass(frozen=True)
class UrlModel:
    weights: np.ndarray
    intercept: float
    bits: int


def split_url(url: str | None) -> tuple[str, str]:
    """(host, path): after the first ``://`` up to ``/ ? #``, A-Z lower-cased; then up to ``? #``."""
    found = URL.search(url or "")
    return (found[1].translate(ASCII_LOWER), found[2]) if found else ("", "")


def best_rule(host: str, path: str, rules=RULES) -> tuple[str | None, str | None]:
    """(text of the longest fitting rule, its verdict); nulls if none fits."""
    fits = [
        (rule_host + rule_path, verdict)
        for rule_host, rule_path, verdict in rules
        if (host == rule_host or host.endswith("." + rule_host)) and path.startswith(rule_path)
    ]
    return max(fits, key=lambda fit: (len(fit[0]), fit)) if fits else (None, None)


def ngrams(host: str, path: str, bits: int, low: int = 3, high: int = 5) -> np.ndarray:
    """Distinct hash cells of the character n-grams of host and path, each marked with its part."""
    cells = set()
    for mark, part in (("h", f"^{host}$"), ("p", path)):
        if len(part) > 2 or mark == "p":
            for n in range(low, high + 1):
                cells.update(zlib.crc32(f"{mark}{part[i:i + n]}".encode()) for i in range(len(part) - n + 1))
    return np.fromiter((c % (1 << bits) for c in cells), np.int64, len(cells))


def labelled_urls() -> list[tuple[str, int]]:
    """The built-in labelled table: (url, 1 = block)."""
    rows = []
    for label, names in ((1, BLOCKED_NAMES), (0, ALLOWED_NAMES)):
        for i, name in enumerate(names):
            for j, ending in enumerate(("example.com", "example.net", "example.org")):
                front = ("", "www.", "m.", "blog.")[(i + j) % 4]
                lang = ("en", "de", "fr", "es")[(i + 2 * j) % 4]
                rows.append((f"https://{front}{name}.{ending}/{lang}/{17 * i + j}.html", label))
    return rows


def fit_url_model(rows=None, bits: int = 16, epochs: int = 60, rate: float = 0.5, l2: float = 1e-4) -> UrlModel:
    """Logistic regression by stochastic gradient descent in numpy; same rows, same model."""
    rows = labelled_urls() if rows is None else rows
    features = [ngrams(*split_url(url), bits) for url, _ in rows]
    labels = np.array([label for _, label in rows], dtype=float)
    weights, intercept = np.zeros(1 << bits), -1.0
    order = np.random.default_rng(7)
    for epoch in range(epochs):
        step = rate / (1 + 0.1 * epoch)
        for i in order.permutation(len(rows)):
            cells = features[i]
            scale = 1 / np.sqrt(max(1, len(cells)))
            p = 1 / (1 + np.exp(-(intercept + scale * weights[cells].sum())))
            weights[cells] -= step * ((p - labels[i]) * scale + l2 * weights[cells])
    return UrlModel(weights.astype(np.float32), intercept, bits)


def block_probability(host: str, path: str, model: UrlModel) -> float:
    cells = ngrams(host, path, model.bits)
    total = float(model.weights[cells].sum()) / np.sqrt(max(1, len(cells)))
    return float(1 / (1 + np.exp(-(model.intercept + total))))


def filter_urls(pages: DataFrame, model: UrlModel | None = None, rules=RULES, url: str = "url", key: str = "page_id") -> DataFrame:
    """``key``, host, path, rule, verdict and the model's block probability, one row per row."""
    model = model or fit_url_model()
    selected = pages.select(key, url)
    kind = selected.schema[0].dataType.simpleString()

    def make():
        def run(keys, urls):
            out = []
            for value in urls:
                host, path = split_url(value)
                rule, verdict = best_rule(host, path, rules)
                score = block_probability(host, path, model)
                out.append((host, path, rule, verdict or ("block" if score >= 0.5 else "allow"), score))
            return keys, *(zip(*out) if out else [[]] * 5)

        return run

    return map_columns(
        selected, f"`{key}` {kind}, host string, path string, rule string, verdict string, score double", make
    )
