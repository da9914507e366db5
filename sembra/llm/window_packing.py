"""Sum-of-squares online packing of token ids into sequences of a fixed window.

Each document's ids (with an end id) are cut into whole windows, which fill a sequence each, and a
rest. Rests are packed online: a level array counts the partially filled sequences at every fill
level, and a rest goes to the level (zero: a new sequence) that minimises the sum of squared
counts after the placement; among equals, to the fullest. A sequence that becomes full is emitted.
At the end of a task the sequences still open are closed from the fullest on: their gaps are filled
with pieces cut from the emptiest ones, and what is left at last becomes sequences whose lengths are
powers of two, so that none is padded. ``placed`` tells the pieces that stand where the level array has
put them from those that were moved then.

Every task packs the rows of its input split, so nothing is shuffled. Memory is bounded by one
Arrow batch and ``MOST_OPEN`` ids of open sequences: beyond, these are closed in the same way, but for the
last. The input must come from files or another source that gives the same splits again, as a task
that is run again must see the same rows. Null texts are empty: one piece with the end id. Repeated
rows are packed each by itself; of equal levels the fullest, of equal sequences the last opened is
used. Whole texts are read; runs of white space longer than ``LONG_SPACE``, which the split pattern
cannot take, are cut by the pattern's own rule before it is applied, so their ids are the same.
"""

from __future__ import annotations

import json
import zlib
from collections import deque
from dataclasses import dataclass

import numpy as np
import regex
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame

from sembra.llm.common import map_batches
from sembra.llm.rank_array_bpe import byte_symbols

PIECE = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, placed boolean"
#: Fixed value: the split pattern of byte-level BPE files that name no pattern of their own.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LONG_SPACE = 10_000
#: White space as the pattern means it.
SPACE_RUN = regex.compile(r"\p{White_Space}{%d,}" % LONG_SPACE)
#: Ids that open sequences hold in a task at most (64 MB).
MOST_OPEN = 1 << 24
#: Sequence numbers of a task start at its partition number times this.
TASK_SEQUENCES = 1 << 40


@dataclass(frozen=True)
class ByteVocabulary:
    ranks: dict[bytes, int]
    special: dict[str, int]


def load_byte_vocabulary(path: str) -> ByteVocabulary:
    """Ranks of a byte-level BPE file of the tokenizers library whose ids follow its merges."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    back = {symbol: b for b, symbol in enumerate(byte_symbols())}
    vocab = spec["model"]["vocab"]
    made = [vocab["".join(pair if isinstance(pair, list) else pair.split(" "))] for pair in spec["model"]["merges"]]
    if made != sorted(made):
        raise ValueError("the ids of this vocabulary do not follow its merges")
    return ByteVocabulary(
        {bytes(back[c] for c in token): i for token, i in vocab.items()},
        {t["content"]: t["id"] for t in spec["added_tokens"]},
    )


class Tokenizer:
    """Ids of whole texts by the vocabulary; special tokens written in a text become theirs."""

    def __init__(self, vocabulary: ByteVocabulary):
        self.special = set(vocabulary.special)
        self.split = tiktoken.Encoding("split", pat_str=PATTERN, mergeable_ranks=vocabulary.ranks, special_tokens=vocabulary.special)
        self.whole = tiktoken.Encoding("whole", pat_str=r"[\s\S]+", mergeable_ranks=vocabulary.ranks, special_tokens={})

    def __call__(self, text: str) -> list[int]:
        ids: list[int] = []
        start = 0
        for run in SPACE_RUN.finditer(text) if len(text) >= LONG_SPACE else ():
            # A run is one piece but for its last character, which belongs to the text that follows.
            follows = run.end() < len(text) and not any(text.startswith(t, run.end()) for t in self.special)
            end = run.end() - follows
            ids += self.split.encode(text[start : run.start()], allowed_special=self.special)
            ids += self.whole.encode(text[run.start() : end], disallowed_special=())
            start = end
        ids += self.split.encode(text[start:], allowed_special=self.special)
        return ids


def crc32_of(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


class Packer:
    """Packs pieces online; ``rows`` receives them as their sequences close."""

    def __init__(self, window: int, first_sequence: int):
        self.window = window
        self.next = first_sequence
        self.counts = np.zeros(window + 1, np.int64)
        self.open: dict[int, list[list]] = {}
        self.held = 0  # ids in open sequences
        self.rows: list[tuple] = []

    def emit(self, pieces: list) -> None:
        offset = 0
        for key, start, ids, total, placed in pieces:
            self.rows.append((key, start, len(ids), crc32_of(ids), total, self.next, offset, placed))
            offset += len(ids)
        self.next += 1

    def level_for(self, size: int) -> int:
        """The fill level whose use gives the least sum of squared counts; full sequences count none.

        Moving a sequence from level h to h + size changes the sum by
        2 * (counts[h + size] - counts[h] + 1), without the second level if it becomes full.
        """
        top = self.window - size
        change = np.full(top + 1, np.iinfo(np.int64).max)
        levels = np.arange(1, top + 1)
        used = levels[self.counts[1 : top + 1] > 0]
        change[used] = 2 * (self.counts[used + size] - self.counts[used]) + 2
        if top in used:
            change[top] = 1 - 2 * self.counts[top]
        change[0] = 2 * self.counts[size] + 1
        return top - int(change[::-1].argmin())

    def place(self, piece: tuple) -> None:
        size = len(piece[2])
        level = self.level_for(size)
        if level:
            bins = self.open[level]
            pieces = bins.pop()
            self.counts[level] -= 1
        else:
            pieces = []
        pieces.append(piece)
        self.held += size
        level += size
        if level == self.window:
            self.held -= self.window
            self.emit(pieces)
        else:
            self.open.setdefault(level, []).append(pieces)
            self.counts[level] += 1
        if self.held > MOST_OPEN:
            self.close(last=False)

    def add(self, key, ids: np.ndarray) -> None:
        total = len(ids)
        whole = total - total % self.window
        for start in range(0, whole, self.window):
            self.emit([(key, start, ids[start : start + self.window], total, True)])
        if whole < total:
            self.place((key, whole, ids[whole:].copy(), total, True))

    def close(self, last: bool = True) -> None:
        """Fill the fullest open sequences with pieces of the emptiest ones.

        At most one sequence is left: open again, or, at the ``last`` call, cut into powers of two.
        """
        waiting = deque(pieces for level in sorted(self.open, reverse=True) for pieces in self.open[level])
        self.open.clear()
        self.counts[:] = 0
        self.held = 0
        moved: list[tuple] = []  # pieces of the emptiest sequence that is being given away, last first
        while waiting or moved:
            pieces = waiting.popleft() if waiting else []
            room = self.window - sum(len(p[2]) for p in pieces)
            while room and (moved or waiting):
                if not moved:
                    moved = waiting.pop()[::-1]
                key, start, ids, total, _ = moved.pop()
                pieces.append((key, start, ids[:room], total, False))
                if len(ids) > room:
                    moved.append((key, start + room, ids[room:], total, False))
                room -= len(pieces[-1][2])
            if not room:
                self.emit(pieces)
            elif last:
                self.emit_powers(pieces)
            else:
                self.open[self.window - room] = [pieces]
                self.counts[self.window - room] = 1
                self.held = self.window - room

    def emit_powers(self, pieces: list) -> None:
        left = sum(len(p[2]) for p in pieces)
        current, room = [], 1 << (left.bit_length() - 1)
        whole = left == room
        for key, start, ids, total, placed in pieces:
            while len(ids):
                taken = min(room, len(ids))
                current.append((key, start, ids[:taken], total, placed and whole))
                ids, start, room, left = ids[taken:], start + taken, room - taken, left - taken
                if not room:
                    self.emit(current)
                    current, room = [], 1 << (left.bit_length() - 1) if left else 0


def pack_documents(
    docs: DataFrame, vocabulary: ByteVocabulary, text: str = "text", key: str = "doc_id", window: int = 2048, end_id: int = 1,
) -> DataFrame:
    """One row per piece: ``key`` and ``PIECE``."""
    selected = docs.select(key, text)
    kind = selected.schema[0].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def pack(batches):
        encode = Tokenizer(shared.value)
        packer = Packer(window, TaskContext.get().partitionId() * TASK_SEQUENCES)
        for keys, texts in batches:
            for name, value in zip(keys, texts):
                packer.add(name, np.array([*encode(value or ""), end_id], np.uint32))
            rows, packer.rows = packer.rows, []
            yield rows
        packer.close()
        yield packer.rows

    return map_batches(selected, f"`{key}` {kind}, {PIECE}", pack)
