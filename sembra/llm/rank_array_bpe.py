"""BPE encoding and decoding with a contiguous rank array per word.

A vocabulary file of the tokenizers library (path as parameter) gives symbols and merges. A text
is normalised (NFC, runs of white space to one space, lower case), cut into words by the file's
pattern, and each word's UTF-8 bytes become symbols, the last with the end-of-word mark. For one
word two arrays are held side by side: the parts, and the rank of each adjacent pair. The least
rank is found by scanning, its boundary is deleted, and only the ranks of the two neighbours are
looked up again, until no pair has a rank. Scanning costs the square of a word's length, so words of
more than ``SCAN_PARTS`` parts keep the same arrays with a heap over the ranks beside them, and
deleted parts are skipped by links; ids are the same. Words repeat, so the ids of short ones are kept
in a bounded cache of the task.

Special tokens written in a text become their ids, as the library does by default. Decoding joins
tokens by spaces, as the library does for a file without a decoder. Null texts are encoded as
empty ones: no ids, empty decoded text. Repeated rows are encoded each by itself; texts are never
cut.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from dataclasses import dataclass

import regex
from pyspark.sql import DataFrame

from sembra.llm.common import map_columns

CACHE_WORDS = 300_000
SPACE = regex.compile(r"\s+")
NO_RANK = 1 << 60
SCAN_PARTS = 100


@dataclass(frozen=True)
class Vocabulary:
    ids: dict[str, int]
    ranks: dict[tuple[str, str], int]
    special: dict[str, int]
    pattern: str
    suffix: str


def load_vocabulary(path: str) -> Vocabulary:
    """The parts of a vocabulary file that encoding needs; the file's size bounds them."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model = spec["model"]
    split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
    return Vocabulary(
        dict(model["vocab"]),
        {tuple(pair): rank for rank, pair in enumerate(model["merges"])},
        {t["content"]: t["id"] for t in spec["added_tokens"]},
        split["pattern"]["Regex"],
        model["end_of_word_suffix"] or "",
    )


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself, or the next one from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    symbols = {b: chr(b) for b in shown}
    for b in range(256):
        if b not in symbols:
            symbols[b] = chr(256 + len(symbols) - len(shown))
    return [symbols[b] for b in range(256)]


def merge_word(parts: list[str], ranks: dict[tuple[str, str], int]) -> list[str]:
    """Merge adjacent parts, least rank first and leftmost among equals, until none has a rank."""
    pair_ranks = [ranks.get(pair, NO_RANK) for pair in zip(parts, parts[1:])]
    while pair_ranks:
        least = min(pair_ranks)
        if least == NO_RANK:
            break
        at = pair_ranks.index(least)
        parts[at] += parts.pop(at + 1)
        del pair_ranks[at]
        if at:
            pair_ranks[at - 1] = ranks.get((parts[at - 1], parts[at]), NO_RANK)
        if at < len(pair_ranks):
            pair_ranks[at] = ranks.get((parts[at], parts[at + 1]), NO_RANK)
    return parts


def merge_long_word(parts: list[str], ranks: dict[tuple[str, str], int]) -> list[str]:
    """As ``merge_word``, for words of any length: the least rank comes from a heap."""
    n = len(parts)
    before, after = list(range(-1, n - 1)), list(range(1, n + 1))
    pair_ranks = [ranks.get(pair, NO_RANK) for pair in zip(parts, parts[1:])] + [NO_RANK]
    heap = [(rank, at) for at, rank in enumerate(pair_ranks) if rank < NO_RANK]
    heapq.heapify(heap)

    def refresh(at: int) -> None:
        pair_ranks[at] = ranks.get((parts[at], parts[after[at]]), NO_RANK) if after[at] < n else NO_RANK
        if pair_ranks[at] < NO_RANK:
            heapq.heappush(heap, (pair_ranks[at], at))

    while heap:
        rank, at = heapq.heappop(heap)
        if pair_ranks[at] != rank:
            continue  # one of its parts has changed since
        gone = after[at]
        parts[at] += parts[gone]
        parts[gone], pair_ranks[gone] = "", NO_RANK
        after[at] = after[gone]
        if after[at] < n:
            before[after[at]] = at
        refresh(at)
        if before[at] >= 0:
            refresh(before[at])
    return [p for p in parts if p]


class Encoder:
    """Encodes and decodes whole texts; one per task."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.words = regex.compile(vocabulary.pattern)
        self.specials = regex.compile("|".join(map(regex.escape, sorted(vocabulary.special, key=len, reverse=True))) or r"(?!)")
        self.bytes = byte_symbols()
        self.tokens = {i: t for t, i in {**vocabulary.ids, **vocabulary.special}.items()}
        self.cache: dict[str, tuple[int, ...]] = {}

    def normalise(self, text: str) -> str:
        text = SPACE.sub(" ", unicodedata.normalize("NFC", text))
        # Lower case goes by character: without the rule for a final sigma.
        return text.replace("Σ", "σ").lower()

    def word_ids(self, word: str) -> tuple[int, ...]:
        ids = self.cache.get(word)
        if ids is None:
            parts = [self.bytes[b] for b in word.encode()]
            parts[-1] += self.v.suffix
            known, short = self.v.ids, len(parts) <= SCAN_PARTS
            merge = merge_word if short else merge_long_word
            ids = tuple(known[p] for p in merge(parts, self.v.ranks) if p in known)
            if short:
                if len(self.cache) >= CACHE_WORDS:
                    self.cache.clear()
                self.cache[word] = ids
        return ids

    def encode(self, text: str) -> list[int]:
        ids: list[int] = []
        start = 0
        for found in self.specials.finditer(text):
            self.add(text[start : found.start()], ids)
            ids.append(self.v.special[found[0]])
            start = found.end()
        self.add(text[start:], ids)
        return ids

    def add(self, text: str, ids: list[int]) -> None:
        for word in self.words.findall(self.normalise(text)):
            ids.extend(self.word_ids(word))

    def decode(self, ids: list[int]) -> str:
        return " ".join(map(self.tokens.__getitem__, ids))


def encode_documents(docs: DataFrame, vocabulary: Vocabulary, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key``, ids and decoded text, one row per row of ``docs``."""
    selected = docs.select(key, text)
    kind = selected.schema[0].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def make():
        encoder = Encoder(shared.value)

        def run(keys, texts):
            ids = [encoder.encode(t or "") for t in texts]
            return keys, ids, [encoder.decode(i) for i in ids]

        return run

    return map_columns(selected, f"`{key}` {kind}, ids array<int>, decoded string", make)


def encode_digests(docs: DataFrame, vocabulary: Vocabulary, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key``, n_tokens, and SHA-256 of the ids (decimal, joined by a space) and of the decoded text.

    The same rows as digests of ``encode_documents``, without sending the ids to the JVM.
    """
    selected = docs.select(key, text)
    kind = selected.schema[0].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def make():
        encoder = Encoder(shared.value)

        def digest(value):
            ids = encoder.encode(value or "")
            numbers, words = " ".join(map(str, ids)), encoder.decode(ids)
            return len(ids), hashlib.sha256(numbers.encode()).hexdigest(), hashlib.sha256(words.encode()).hexdigest()

        def run(keys, texts):
            return keys, *(zip(*map(digest, texts)) if texts else [[]] * 3)

        return run

    return map_columns(selected, f"`{key}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string", make)
