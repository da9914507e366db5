"""N-gram Jaccard join by token-combination prefixes, and the components of its links.

A document's set holds the hashes of its distinct k-word shingles. Shingles have one global order:
rare ones first, then frequent ones, each by hash. Frequent is what a counting sketch over all
rows says (it never counts too low). Two documents whose similarity reaches the threshold share
enough of a prefix of this order:

* of a document with n shingles at most ``n - ceil(threshold * n)`` may be missing from a partner,
  so a prefix with one rare shingle more must share one. Rare shingles are indexed singly.
* where the rare ones do not suffice, the prefix is extended by frequent shingles. These are dealt
  into groups by hash; a group with p shingles in the prefix counts p - 1, because a partner that
  shares no *pair* of a group lacks at least p - 1 of them. Pairs are indexed. The number of groups
  follows the size bracket (powers of two), and documents that can have a larger partner in the
  next bracket are indexed for that one too, so that partners always use the same groups.

Index entries are sorted by signature. Short runs give all their pairs of fitting sizes; a pair
must share as many prefix shingles as the threshold needs before it is verified. Of a run longer
than ``LONG_RUN`` (many near copies) every member is paired with one pivot. Near copies share
hundreds of signatures but name few pivots, so their distinct pairs grow with the number of
documents. Distances to pivots settle most of the rest, as 1 - similarity obeys the triangle
inequality (``link_long_runs``); runs of those that are left are searched anew with other pivots,
and at last what lies in different components of one run, and may be linked by its sizes, is
measured pair by pair. No link between components is lost.

Candidates are verified on their whole texts. Exact copies of a set are one class from the start.

Results: rows with a null ``doc_id`` get their set size and a null component; rows that share a
``doc_id`` are one document; texts that are null or without words have no shingles and are alone.
Repeated rows give repeated results.
"""

from __future__ import annotations

import functools
import hashlib
import zlib
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from sembra.session import lookup_join, materialize

SKETCH_BITS = 24
BLOCK_BITS = 16
LONG_RUN = 128
BITMAP_BITS = 1_024
EDGE_BLOCK_ROWS = 256
CACHE_WORDS = 150_000
#: Rows of texts that are in Python's hands at once.
SLICE_ROWS = 512
#: Hashes that are counted at once, or those of one text.
COUNTED = 1 << 17
MIX = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Jaccard:
    """Links need ``100 * intersection >= percent * union`` on k-word shingles."""

    words: int = 5
    percent: int = 80

    def __post_init__(self):
        if not 51 <= self.percent <= 100:
            raise ValueError("percent must be from 51 to 100")

    def groups(self, bracket: int) -> int:
        """Groups of frequent shingles for sets of this size bracket.

        More groups need fewer pairs. But every group may hold one shingle that counts for nothing,
        so they are the most (a half, quarter ... of the least size) with which any set of the
        bracket, or of the one below with a partner in it, can still fill its prefix.
        """
        return max(1, (1 << bracket) // _group_share(self.percent))

    def prefix(self, n):
        """How much of a set of n must be indexed for one shared shingle to be certain."""
        return n - -(-self.percent * n // 100) + 1

    def overlap(self, n, m):
        """The least intersection of linked sets of n and m."""
        return -(-self.percent * (n + m) // (100 + self.percent))

    def fits(self, n, m):
        """Whether sets of these sizes can be linked."""
        return 100 * np.minimum(n, m) >= self.percent * np.maximum(n, m)


@functools.cache
def _group_share(percent: int) -> int:
    rule = Jaccard(1, percent)

    def enough(share: int) -> bool:
        return all(
            n - max(1, (1 << b) // share) >= rule.prefix(n)
            for n in range(1, 2_000)
            if 100 * n >= percent * (n + 1)
            for b in range(n.bit_length() - 1, (100 * n // percent).bit_length())
        )

    return next(share for share in (2, 4, 8, 16, 32, 64) if enough(share))


class Shingler:
    """Sorted distinct 64-bit hashes of a text's shingles; words are hashed once while cached."""

    def __init__(self, words: int):
        self.k = words
        self.cache: dict[bytes, int] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        words = (text or "").encode().lower().split()
        if len(self.cache) > CACHE_WORDS:
            self.cache.clear()
        cache, hashes = self.cache, []
        for word in words:
            value = cache.get(word)
            if value is None:
                value = cache[word] = xxhash.xxh3_64_intdigest(word)
            hashes.append(value)
        h = np.array(hashes, np.uint64)
        if not len(h):
            return h
        k = min(self.k, len(h))
        out = np.full(len(h) - k + 1, k, np.uint64)
        for i in range(k):
            out = (out ^ h[i : len(h) - k + 1 + i]) * MIX
            out ^= out >> np.uint64(29)
        return np.unique(out)


def slices(batches):
    """Arrow batches in parts of few rows, so that lists and arrays made of them stay small."""
    for batch in batches:
        for start in range(0, batch.num_rows, SLICE_ROWS):
            yield batch.slice(start, SLICE_ROWS)


# --- one pass: set sizes, digests, and counts for the sketch ---


def scan_sets(docs: DataFrame, rule: Jaccard, text: str, key: str) -> DataFrame:
    """Per row (doc, n, same, digest), and per task the counters of the sketch by block; written once.

    ``same`` is the document that had the same set first in the task; only its row has the digest, so
    a class of copies has a digest row a task, whatever its size.
    """
    schema = "doc long, n long, same long, digest binary, block int, counters binary"
    types = pa.schema(
        [("doc", pa.int64()), ("n", pa.int64()), ("same", pa.int64()), ("digest", pa.binary()), ("block", pa.int32()), ("counters", pa.binary())]
    )

    def run(batches):
        shingler, firsts = Shingler(rule.words), {}
        counts = np.zeros(1 << SKETCH_BITS, np.uint16)

        def count(sets):
            if sets:
                np.add.at(counts, (np.concatenate(sets) >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), np.uint16(1))

        for batch in slices(batches):
            sizes, same, digests, waiting, held = [], [], [], [], 0
            for doc, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = shingler(value)
                sizes.append(len(found))
                if doc is None or not len(found):
                    same.append(None)
                    digests.append(None)
                else:
                    digest = hashlib.blake2b(found.tobytes(), digest_size=16).digest()
                    digests.append(None if digest in firsts else digest)
                    same.append(firsts.setdefault(digest, doc))
                waiting.append(found)
                held += len(found)
                if held > COUNTED:
                    count(waiting)
                    waiting, held = [], 0
            count(waiting)
            # Saturating before the 16 bits of a counter can overflow in the next batches.
            np.minimum(counts, 1 << 14, out=counts)
            none = pa.nulls(len(sizes))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(same, pa.int64()), pa.array(digests, pa.binary()),
                 none.cast(pa.int32()), none.cast(pa.binary())], schema=types,
            )
        blocks = np.minimum(counts, 255).astype(np.uint8).reshape(-1, 1 << BLOCK_BITS)
        used = [b for b in range(len(blocks)) if blocks[b].any()]
        none = pa.nulls(len(used))
        yield pa.RecordBatch.from_arrays(
            [none.cast(pa.int64()), none.cast(pa.int64()), none.cast(pa.int64()), none.cast(pa.binary()), pa.array(used, pa.int32()),
             pa.array([zlib.compress(blocks[b].tobytes(), 1) for b in used], pa.binary())], schema=types,
        )

    selected = docs.select(F.col(key).cast("long"), text)
    return materialize(selected.mapInArrow(run, schema), "jaccard-scan")


def frequent_bits(scan: DataFrame, total: int) -> np.ndarray:
    """Packed bits of the sketch's frequent cells: 2 ** SKETCH_BITS / 8 bytes, whatever the input.

    A cell is frequent above what cells of once-seen shingles hold by chance, so the limit follows
    the number of shingles.
    """
    mean = total / (1 << SKETCH_BITS)
    limit = mean + 6 * mean**0.5 + 8

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, counters in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                values = np.frombuffer(zlib.decompress(counters), np.uint8)
                sums[block] = sums.get(block, 0) + values.astype(np.uint32)
        rows = {b: zlib.compress(np.packbits(v > limit).tobytes(), 1) for b, v in sums.items()}
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(rows), pa.int32()), pa.array(list(rows.values()), pa.binary())], names=["block", "bits"]
        )

    blocks = scan.where(F.col("block").isNotNull()).select("block", "counters").repartition("block")
    bits = np.zeros((1 << (SKETCH_BITS - BLOCK_BITS), 1 << (BLOCK_BITS - 3)), np.uint8)
    for row in blocks.mapInArrow(add, "block int, bits binary").collect():
        bits[row.block] = np.frombuffer(zlib.decompress(bytes(row.bits)), np.uint8)
    return bits.reshape(-1)


# --- signatures ---


def pair_signatures(tokens: np.ndarray, need: int, bracket: int, n_groups: int) -> list[int]:
    """Hashes of the indexed pairs of frequent shingles, taken in order until they count ``need``."""
    groups: dict[int, list[int]] = {}
    counted = 0
    for token in tokens.tolist():
        members = groups.setdefault((token >> 7) % n_groups, [])
        counted += bool(members)
        members.append(token)
        if counted == need:
            break
    mask, salt = (1 << 64) - 1, 0xC2B2AE3D27D4EB4F * (bracket + 1)
    return [
        ((a * 0x9E3779B97F4A7C15 ^ b) * 0xD6E8FEB86659FD93 + salt) & mask
        for members in groups.values()
        for a, b in combinations(members, 2)
    ]


def signatures_of(found: np.ndarray, bits: np.ndarray, rule: Jaccard) -> tuple[np.ndarray, int, int]:
    """(signatures of a set, how many of them are single rare shingles, frequent shingles of the set).

    The last is -1 where the prefix needs no frequent ones.
    """
    n = len(found)
    if 100 * n < rule.percent * (n + 1):
        return found[:0], 0, -1  # nothing but an equal set can be linked
    cells = (found >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)
    frequent = (bits[cells >> 3] >> (7 - (cells & 7)).astype(np.uint8)) & 1 == 1
    rare, need = found[~frequent], rule.prefix(n)
    if len(rare) >= need:
        return rare[:need], need, -1
    bracket, largest = n.bit_length() - 1, 100 * n // rule.percent
    pairs: list[int] = []
    for b in range(bracket, largest.bit_length()):
        pairs += pair_signatures(found[frequent], need - len(rare), b, rule.groups(b))
    return np.concatenate([rare, np.array(pairs, np.uint64)]), len(rare), int(frequent.sum())


def index_entries(docs: DataFrame, bits: np.ndarray, rule: Jaccard, text: str, key: str) -> DataFrame:
    """(sig, doc, n, f): n is negative where pairs of frequent shingles are among the signatures, f is
    the number of the set's frequent shingles in the entries of such pairs, -1 in all others.

    Copies within a task are indexed once; exact classes hold all of them together anyway.
    """
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches):
        shingler, seen, table = Shingler(rule.words), set(), shared.value
        for batch in slices(batches):
            sigs, names, sizes, commons = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int32)], [np.zeros(0, np.int32)]
            for doc, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = shingler(value)
                digest = hashlib.blake2b(found.tobytes(), digest_size=16).digest()
                if digest in seen:
                    continue
                seen.add(digest)
                own, singles, frequent = signatures_of(found, table, rule)
                sigs.append(own)
                names.append(np.full(len(own), doc, np.int64))
                sizes.append(np.full(len(own), len(found) if frequent < 0 else -len(found), np.int32))
                commons.append(np.where(np.arange(len(own)) < singles, -1, frequent).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(sigs).view(np.int64)), *(pa.array(np.concatenate(c)) for c in (names, sizes, commons))],
                names=["sig", "doc", "n", "f"],
            )

    selected = docs.where(F.col(key).isNotNull()).select(F.col(key).cast("long"), text)
    return selected.mapInArrow(run, "sig long, doc long, n int, f int")


# --- candidates ---


def run_candidates(entries: DataFrame, rule: Jaccard, salt: int = 0) -> DataFrame:
    """From entries dealt by signature: all pairs (a, b, na, nb) of short runs, with a null ``sig``, and
    of long runs the pair of every member a with the run's pivot b, the first of its order.

    The pivot is the document with the fewest rare shingles, which lies in the middle of its near
    copies, so one document is the pivot of most runs of its copies; with ``salt`` it is one by hash.
    Runs of one document give nothing.
    """

    def pairs_of(docs, sizes):
        i, j = np.triu_indices(len(docs), 1)
        good = (docs[i] != docs[j]) & rule.fits(np.abs(sizes[i]), np.abs(sizes[j]))
        return np.stack([docs[i[good]], docs[j[good]], sizes[i[good]], sizes[j[good]]])

    def run(batches):
        tail = None
        for batch in batches:
            columns = [np.asarray(c) for c in batch.columns]
            if tail is not None:
                columns = [np.concatenate(x) for x in zip(tail, columns)]
            yield from emit(columns, False)
            tail = emit.tail
        if tail is not None:
            yield from emit(tail, True)

    def emit(columns, last):
        sig, doc, n, f = columns
        starts = np.flatnonzero(np.r_[True, sig[1:] != sig[:-1]]) if len(sig) else np.zeros(0, np.int64)
        ends = np.r_[starts[1:], len(sig)]
        keep, open_run = len(sig), emit.long
        pair_parts, members, pivots = [np.zeros((4, 0), np.int64)], [np.zeros(0, np.int64)], [np.zeros((3, 0), np.int64)]
        if not last and len(starts):
            keep = starts[-1]
            if sig[-1] == emit.long or len(sig) - keep > LONG_RUN:
                # A long run is handed on at once, without waiting for its end.
                emit.long, keep = sig[-1], len(sig)
        emit.tail = [c[keep:] for c in columns]
        inside = starts < keep
        starts, ends = starts[inside], np.minimum(ends[inside], keep)
        lengths = ends - starts
        is_long = lengths > LONG_RUN
        for sign in (open_run, emit.long):
            if sign is not None:
                is_long |= sig[starts] == sign
        two = starts[(lengths == 2) & ~is_long]
        two = two[(doc[two] != doc[two + 1]) & rule.fits(np.abs(n[two]), np.abs(n[two + 1]))]
        pair_parts.append(np.stack([doc[two], doc[two + 1], n[two], n[two + 1]]))
        for s, e in zip(starts[(lengths > 2) & ~is_long], ends[(lengths > 2) & ~is_long]):
            pair_parts.append(pairs_of(doc[s:e], n[s:e]))
        for s, e in zip(starts[is_long], ends[is_long]):
            if sig[s] != open_run:
                emit.pivot = np.array([doc[s], n[s], f[s]], np.int64)[:, None]
            rows = np.arange(s, e)[doc[s:e] != emit.pivot[0, 0]]
            members.append(rows)
            pivots.append(np.repeat(emit.pivot, len(rows), axis=1))
        a, b, na, nb = np.concatenate(pair_parts, axis=1)
        swap = a > b
        a, b, na, nb = np.where(swap, b, a), np.where(swap, a, b), np.where(swap, nb, na), np.where(swap, na, nb)
        rows, (other, m, g) = np.concatenate(members), np.concatenate(pivots, axis=1)
        none = pa.nulls(len(a), pa.int32())
        yield pa.RecordBatch.from_arrays(
            [
                pa.concat_arrays([pa.nulls(len(a), pa.int64()), pa.array(sig[rows])]),
                pa.array(np.concatenate([a, doc[rows]])),
                pa.array(np.concatenate([b, other])),
                pa.array(np.concatenate([na, n[rows]]).astype(np.int32)),
                pa.array(np.concatenate([nb, m]).astype(np.int32)),
                pa.concat_arrays([none, pa.array(f[rows].astype(np.int32))]),
                pa.concat_arrays([none, pa.array(g.astype(np.int32))]),
            ],
            names=["sig", "a", "b", "na", "nb", "fa", "fb"],
        )

    def fresh(batches):
        emit.long, emit.tail, emit.pivot = None, None, None
        yield from run(batches)

    size = F.abs("n")
    order = [F.when(F.col("f") < 0, size).otherwise(size - F.col("f")), size, F.col("doc")]
    if salt:
        order.insert(0, F.xxhash64("doc", F.lit(salt)))
    dealt = entries.repartition("sig").sortWithinPartitions("sig", *order)
    return dealt.mapInArrow(fresh, "sig long, a long, b long, na int, nb int, fa int, fb int")


def enough_shared(pairs: DataFrame, rule: Jaccard) -> DataFrame:
    """Pairs that share as many rare prefix shingles as a link needs.

    The document whose prefix ends first has all its shared prefix shingles in the other's prefix;
    beyond the misses that the pair may have, its prefix is shared. Which one that is stays open, so
    the lesser need counts; prefixes with frequent shingles need one.
    """
    n, m = F.abs("na").cast("long"), F.abs("nb").cast("long")
    least = F.ceil(rule.percent * (n + m) / F.lit(100 + rule.percent))

    def need(size, signed):
        prefix = size - F.ceil(rule.percent * size / F.lit(100)) + 1
        return F.when(F.col(signed) < 0, F.lit(1)).otherwise(prefix - (size - least))

    counted = pairs.groupBy("a", "b").agg(
        F.count(F.lit(1)).alias("shared"), F.first("na").alias("na"), F.first("nb").alias("nb")
    )
    return counted.where(F.col("shared") >= F.least(need(n, "na"), need(m, "nb"))).select("a", "b")


# --- verification ---


def needed_texts(docs: DataFrame, pairs: DataFrame, text: str, key: str) -> DataFrame:
    """(doc, text) of the documents in ``pairs``.

    A bit table of fixed size, made from the pairs' ids, keeps other texts from being moved; what it
    lets through by chance finds no partner in the join. Its blocks are made in tasks and come in one job.
    """
    bits, block_bits = 22, 15
    ids = pairs.select(F.explode(F.array("a", "b")).alias("doc"))
    cell = F.shiftrightunsigned(F.xxhash64("doc"), 64 - bits).cast("int")
    at = F.shiftright(cell, block_bits).alias("block"), cell.bitwiseAND((1 << block_bits) - 1).cast("long").alias("place")
    table = np.zeros((1 << (bits - block_bits), 1 << (block_bits - 3)), np.uint8)
    for row in ids.select(*at).groupBy("block").agg(F.bitmap_construct_agg("place").alias("bits")).collect():
        table[row.block] = np.frombuffer(bytes(row.bits), np.uint8)
    shared = docs.sparkSession.sparkContext.broadcast(table.reshape(-1))

    def run(batches):
        packed = shared.value
        for batch in batches:
            at = np.asarray(batch.column(2))
            hit = (packed[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
            yield batch.filter(pa.array(hit)).select([0, 1])

    named = docs.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("doc"), F.col(text).alias("text"))
    return named.withColumn("cell", cell).mapInArrow(run, "doc long, text string")


def bitmap(found: np.ndarray) -> bytes:
    """Parities of a set's hashes in ``BITMAP_BITS`` cells: two sets differ in at least as many shingles
    as their bitmaps do in bits."""
    odd = np.bincount((found >> np.uint64(40)).astype(np.int64) % BITMAP_BITS, minlength=BITMAP_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def measured(docs: DataFrame, pairs: DataFrame, rule: Jaccard, text: str, key: str) -> DataFrame:
    """(a, b, linked, apart, size, bits) of ``pairs`` by their whole texts.

    ``apart`` is 1 - similarity; ``size`` and ``bits`` are the set size and the bitmap of a. A ``key`` with
    several texts gives a row for each pair of them.
    """
    texts = needed_texts(docs, pairs, text, key)
    first = texts.select(F.col("doc").alias("a"), F.col("text").alias("ta"))
    second = texts.select(F.col("doc").alias("b"), F.col("text").alias("tb"))
    joined = pairs.select("a", "b").join(first, "a").join(second, "b").select("a", "b", "ta", "tb")

    schema = StructType.fromDDL("a long, b long, linked boolean, apart double, size long, bits binary")

    def run(batches):
        shingler, types, last, y = Shingler(rule.words), to_arrow_schema(schema), None, None
        for batch in slices(batches):
            out = []
            for a, b, ta, tb in zip(*(c.to_pylist() for c in batch.columns)):
                if last != tb:
                    last, y = tb, shingler(tb)
                x = shingler(ta)
                both = len(np.intersect1d(x, y, assume_unique=True))
                either = len(x) + len(y) - both
                out.append((a, b, 100 * both >= rule.percent * either, 1 - both / max(1, either), len(x), bitmap(x)))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), types)], schema=types)

    return joined.mapInArrow(run, schema)


def verified(docs: DataFrame, pairs: DataFrame, rule: Jaccard, text: str, key: str) -> DataFrame:
    """The pairs (a, b) whose whole texts reach the threshold."""
    return measured(docs, pairs, rule, text, key).where("linked").select("a", "b").distinct()


# --- components ---


def components(links: DataFrame) -> DataFrame:
    """(node, root) for the nodes of ``links(a, b)``: root is the least node that can be reached.

    Every round each node takes its least neighbour as parent, chains of parents are halved until
    they end at roots, and links between roots go on; the number of roots at least halves. Rounds
    are written to the shared folder.
    """
    spark = links.sparkSession
    edges = materialize(links.where("a <> b").select("a", "b").distinct(), "links")
    labels = None
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        parents = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
        parents = materialize(parents.select("node", F.least("node", "low").alias("root")), "parents")
        while True:
            up = parents.select(F.col("node").alias("root"), F.col("root").alias("next"))
            jumped = materialize(
                parents.join(up, "root").select("node", F.col("next").alias("root"), (F.col("next") != F.col("root")).alias("moved")),
                "parents",
            )
            parents = jumped.select("node", "root")
            if jumped.where("moved").isEmpty():
                break
        if labels is None:
            labels = parents
        else:
            up = parents.select(F.col("node").alias("root"), F.col("root").alias("next"))
            labels = materialize(
                labels.join(up, "root", "left").select("node", F.coalesce("next", "root").alias("root")), "labels"
            )
        pa_, pb_ = parents.toDF("a", "ra"), parents.toDF("b", "rb")
        moved = edges.join(pa_, "a").join(pb_, "b").where("ra <> rb")
        edges = materialize(moved.select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct(), "links")
    return labels if labels is not None else spark.createDataFrame([], "node long, root long")


def absorb(roots: DataFrame, links: DataFrame) -> DataFrame:
    """``roots(node, root)`` after ``links(a, b)`` have joined components; only roots are linked anew."""
    ends = links
    for side in "ab":
        known = roots.toDF(side, f"r{side}")
        ends = ends.join(known, side, "left").withColumn(side, F.coalesce(f"r{side}", side)).drop(f"r{side}")
    ends = materialize(ends.where("a <> b").select("a", "b").distinct(), "root-links")
    if ends.isEmpty():
        return roots
    onward = components(ends)
    moved = roots.join(onward.toDF("root", "next"), "root", "left").select("node", F.coalesce("next", "root").alias("root"))
    fresh = onward.join(roots, "node", "left_anti")
    return materialize(moved.union(fresh), "roots")


def edge_pairs(edge: DataFrame, inner: DataFrame, rule: Jaccard) -> DataFrame:
    """Pairs (a, b) of ``edge(doc, b, low, size, bits)`` and ``inner(other, b, high, size, bits)`` of one
    pivot that may be linked by their distances to it and by their bitmaps.

    The direct neighbours of a pivot are cut into blocks that meet all edge members of the pivot; only
    pairs that pass leave a task.
    """
    reach = 1 - rule.percent / 100
    blocks = inner.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / F.lit(EDGE_BLOCK_ROWS)).cast("int").alias("blocks"))
    blocks = materialize(blocks, "edge-blocks")
    inside = lookup_join(inner, blocks, ["b"], spread_by="other")
    inside = inside.withColumn("block", F.pmod(F.xxhash64("other"), F.col("blocks")).cast("int")).drop("blocks")
    outside = lookup_join(edge, blocks, ["b"], spread_by="doc")
    outside = outside.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def words(column):
        return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(-1, BITMAP_BITS // 64)

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [np.zeros((2, 0), np.int64)]
        if left.num_rows and right.num_rows:
            doc, low, size, bits = left["doc"].to_numpy(), left["low"].to_numpy(), left["edge_size"].to_numpy(), words(left["edge_bits"])
            other, high, m, others = right["other"].to_numpy(), right["high"].to_numpy(), right["size"].to_numpy(), words(right["bits"])
            for i in range(len(doc)):
                near = np.flatnonzero((high >= low[i] - reach - 1e-9) & rule.fits(size[i], m) & (other != doc[i]))
                differ = np.bitwise_count(others[near] ^ bits[i]).sum(1, dtype=np.int64)
                near = near[differ * (100 + rule.percent) <= (100 - rule.percent) * (size[i] + m[near])]
                out.append(np.stack([np.minimum(doc[i], other[near]), np.maximum(doc[i], other[near])]))
        a, b = np.concatenate(out, axis=1)
        return pa.table([pa.array(a), pa.array(b)], schema=schema)

    # Both come from one table: new names tell their columns apart.
    outside = outside.select("doc", "low", *[F.col(c).alias(f"edge_{c}") for c in ("b", "block", "size", "bits")])
    met = outside.groupBy("edge_b", "edge_block").cogroup(inside.groupBy("b", "block")).applyInArrow(meet, "a long, b long")
    return materialize(met.distinct(), "edge-pairs")


def link_long_runs(docs, stars, roots, rule, text, key, rounds=3):
    """``roots`` (node, root) after the links among documents which meet in long runs.

    ``stars`` holds (sig, a, b, na, nb, fa, fb): every member a of a long run with its pivot b. Near copies
    name few pivots, so the distinct pairs (a, b) are few however many signatures the copies share;
    they are all that is joined and measured. With t = 1 - threshold, and distances that obey the
    triangle inequality, a member farther than 2 t from the pivot is linked with nobody who is linked
    with the pivot directly. What is left:

    * members within 2 t of the pivot, but in another component, are compared with the direct
      neighbours of the pivot: by distances and bitmaps first, then by their texts (``edge_pairs``);
    * members that are no direct neighbours meet again, if any of their run is in another component than
      the pivot: their runs, without the others, are searched anew, with other pivots.

    After ``rounds`` rounds the pairs left between different components of one signature are measured,
    less those that cannot be linked by their sizes (``can_link``).
    """
    reach = 1 - rule.percent / 100
    for turn in range(1, rounds + 1):
        pairs = materialize(stars.select("a", "b", "na", "nb", "fa", "fb").distinct(), "star-pairs")
        near = measured(docs, pairs.where(can_link(rule, 2 * rule.percent - 100)).select("a", "b").distinct(), rule, text, key)
        near = near.groupBy("a", "b").agg(
            F.max("linked").alias("linked"), F.min("linked").alias("direct"), F.min("apart").alias("low"), F.max("apart").alias("high"),
            F.count(F.lit(1)).alias("texts"), F.first("size").alias("size"), F.first("bits").alias("bits"),
        )
        near = materialize(near, "star-distances")
        roots = absorb(roots, near.where("linked").select("a", "b"))
        judged = pairs.select("a", "b").distinct().join(near.drop("linked"), ["a", "b"], "left")
        for side in "ab":
            judged = judged.join(roots.toDF(side, f"r{side}"), side, "left").withColumn(f"r{side}", F.coalesce(f"r{side}", side))
        judged = judged.withColumns({"direct": F.coalesce("direct", F.lit(False)), "open": F.col("ra") != F.col("rb")}).drop("ra", "rb")
        judged = materialize(judged, "stars")
        edge = judged.where(F.col("open") & (F.col("low") <= 2 * reach + 1e-9))
        if not edge.isEmpty():
            # A key with several texts has several sizes and bitmaps: it is compared by its texts only.
            single = F.col("texts") == 1
            direct = judged.where("direct")
            met = edge_pairs(
                edge.where(single).select(F.col("a").alias("doc"), "b", "low", "size", "bits"),
                direct.where(single).select(F.col("a").alias("other"), "b", "high", "size", "bits"), rule,
            )
            several = edge.select(F.col("a").alias("doc"), "b", "texts").join(direct.select(F.col("a").alias("other"), "b", F.col("texts").alias("more")), "b")
            several = several.where((F.col("texts") > 1) | (F.col("more") > 1))
            several = several.select(F.least("doc", "other").alias("a"), F.greatest("doc", "other").alias("b")).where("a <> b")
            if not judged.where(~single).isEmpty():
                met = materialize(met.union(several).distinct(), "edge-pairs")
            roots = absorb(roots, verified(docs, met, rule, text, key))
        rest = stars.join(judged.where("not direct").select("a", "b", "open"), ["a", "b"])
        rest = materialize(rest.select("sig", F.col("a").alias("doc"), F.col("na").alias("n"), F.col("fa").alias("f"), "open"), "rest")
        rest = rest.join(rest.where("open").select("sig").distinct(), "sig", "left_semi").drop("open")
        if rest.isEmpty():
            return roots
        if turn < rounds:
            found = materialize(run_candidates(rest, rule, turn), "candidates")
            roots = absorb(roots, verified(docs, found.where("sig is null").select("a", "b").distinct(), rule, text, key))
            stars = found.where("sig is not null")
            if stars.isEmpty():
                return roots
    named = rest.join(roots.withColumnRenamed("node", "doc"), "doc", "left")
    kept = named.select("sig", F.col("doc").alias("a"), F.col("n").alias("na"), F.col("f").alias("fa"), F.coalesce("root", "doc").alias("ra"))
    other = kept.toDF("sig", "b", "nb", "fb", "rb")
    pairs = kept.join(other, "sig").where((F.col("ra") < F.col("rb")) & can_link(rule, rule.percent)).select("a", "b").distinct()
    return absorb(roots, verified(docs, materialize(pairs, "long-pairs"), rule, text, key))


def can_link(rule: Jaccard, percent: int):
    """Whether sets of na and nb shingles, fa and fb of them frequent (-1: not known), can reach ``percent``
    by what their entries of one signature say.

    Documents whose prefixes hold frequent shingles index all their rare ones singly, so if they share
    a rare one they are candidates by it too; by pairs of frequent ones alone they share frequent ones
    at most, and both must have as many as the link needs.
    """
    n, m = F.abs("na").cast("long"), F.abs("nb").cast("long")
    least = F.ceil(percent * (n + m) / F.lit(100 + percent))
    if percent < rule.percent:
        return F.least(n, m) >= least
    shared = F.when((F.col("fa") < 0) | (F.col("fb") < 0), F.least(n, m)).otherwise(F.least("fa", "fb"))
    return shared >= least


def jaccard_join(docs: DataFrame, rule: Jaccard = Jaccard(), text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key``, n_shingles and component_id, one row per row of ``docs``."""
    scan = scan_sets(docs, rule, text, key)
    rows = scan.where(F.col("block").isNull()).select("doc", "n", "same", "digest")
    total = rows.agg(F.sum("n")).head()[0] or 0
    bits = frequent_bits(scan, total)
    known = rows.where("same is not null")
    # Copies within a task are linked with the first of them, these with the least one of all tasks.
    tasks = known.where("digest is not null").select("digest", F.col("same").alias("a"))
    least = tasks.groupBy("digest").agg(F.min("a").alias("b"))
    copies = known.select(F.col("doc").alias("a"), F.col("same").alias("b")).union(tasks.join(least, "digest").select("a", "b"))
    copies = materialize(copies.where("a <> b").distinct(), "exact-classes")
    found = materialize(run_candidates(index_entries(docs, bits, rule, text, key), rule), "candidates")
    pairs = materialize(enough_shared(found.where("sig is null").select("a", "b", "na", "nb"), rule), "pairs")
    links = materialize(verified(docs, pairs, rule, text, key), "verified")
    # A doc_id with several sets joins their classes.
    roots = components(links.union(copies))
    stars = found.where("sig is not null")
    if not stars.isEmpty():
        roots = link_long_runs(docs, stars, roots, rule, text, key)
    kind = docs.schema[key].dataType
    return (
        rows.join(roots.withColumnRenamed("node", "doc"), "doc", "left")
        .select(
            F.col("doc").cast(kind).alias(key), F.col("n").alias("n_shingles"),
            F.coalesce("root", "doc").alias("component_id"),
        )
    )


def jaccard_sql(words: int, percent: int) -> str:
    """The contract's rows in DuckDB SQL over the view ``documents``."""
    parts = " || ' ' || ".join(["w[i]", *[f"w[i + {j}]" for j in range(1, words)]])
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
),
s AS (
  SELECT DISTINCT doc_id, {parts} AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - {words - 2})) AS i FROM d WHERE len(w) >= {words})
  UNION ALL
  SELECT DISTINCT doc_id, array_to_string(w, ' ') FROM d WHERE len(w) BETWEEN 1 AND {words - 1}
),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
linked AS (
  SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= {percent} * (x.n + y.n - c)
),
reach AS (
  SELECT doc_id AS node, doc_id AS other FROM d
  UNION
  SELECT reach.node, linked.b FROM reach JOIN linked ON reach.other = linked.a
),
lowest AS (SELECT node, min(other) AS component_id FROM reach GROUP BY node)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, component_id
FROM d LEFT JOIN n USING (doc_id) JOIN lowest ON lowest.node = d.doc_id"""
