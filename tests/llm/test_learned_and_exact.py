"""Quality by subwords, Ptolemaic clusters and spelling automata against plain versions."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

from sembra.llm import ptolemy_clusters as pc
from sembra.llm import quality_subwords as qs
from sembra.llm import spelling_automata as sa
from sembra.llm.common import fold

DATA = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, quality int, score double, n long, word string, label_rows int, v string, head string"


def rows_of(texts):
    return [(i, t, 1, 1.0, 2, "w", 3, "v", "h") for i, t in texts]


@pytest.fixture(scope="module")
def odd(spark):
    """Null and empty texts, a null id, repeated rows and ids, a very long text and a very long word."""
    long = " ".join(f"wörd{chr(97 + i % 26)}{chr(97 + i % 7)}" for i in range(200_000))
    texts = [(1, None), (2, ""), (3, " \n\t "), (4, "plain words here"), (4, "plain words here"), (None, "plain words here"), (6, long), (7, "x" * 300_000)]
    return spark.createDataFrame(rows_of(texts), SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


# --- quality ---

MASK = (1 << 64) - 1


def plain_cell(key, salt):
    m = ((key ^ (salt * 0xC2B2AE3D27D4EB4F & MASK)) * 0x9E3779B97F4A7C15) & MASK
    m ^= m >> 31
    return (m * 0x9E3779B97F4A7C15 & MASK) >> (64 - qs.BITS)


def plain_units(text):
    words = (text or "").encode().split()
    h = [xxhash.xxh3_64_intdigest(w) for w in words]
    found = [plain_cell(x, qs.WORD) for x in h]
    found += [qs.AGAIN if a == b else plain_cell((a * 0x9E3779B97F4A7C15 + b) & MASK, qs.PAIR) for a, b in zip(h, h[1:])]
    joined = b" " + b" ".join(words) + b" " if words else b""
    for n in (3, 4, 5):
        found += [plain_cell(int.from_bytes(joined[i : i + n], "little"), qs.GRAM + n) for i in range(len(joined) - n + 1)]
    return Counter(found)


def test_units_and_scores_equal_a_plain_loop(docs, monkeypatch):
    monkeypatch.setattr(qs, "SLICE_BYTES", 64)
    units, draw = qs.Units(), np.random.default_rng(3)
    model = qs.QualityModel(0.3, draw.normal(size=qs.CELLS))
    score = qs.scorer(model)
    for text in [None, "", " \n", "a", "a a a b", "héé !! ### x", *[r.text for r in docs.limit(30).collect()]]:
        plain = plain_units(text)
        assert sum((Counter(c.tolist()) for c in units(text)), Counter()) == plain
        mean = sum(n * model.slopes[c] for c, n in plain.items()) / max(1, sum(plain.values()))
        assert math.isclose(score(text), 1 / (1 + math.exp(-max(-30, min(30, 0.3 + mean)))), rel_tol=1e-9)


def test_the_gradient_is_that_of_the_loss():
    """One step on one row moves vectors and output against the numerical slope of its loss."""
    cells, shares = np.array([3, 9]), np.array([0.25, 0.75], np.float32)
    before = qs.descend([(cells, shares)], np.array([1]), np.array([0]), np.ones(2), np.random.default_rng(1), 4, 2, 1e-2, 0.0)
    vectors, output, bias = (a.astype(float) for a in before)

    def loss(v, o):
        z = shares @ v[cells] @ o + bias
        return -(z[1] - np.log(np.exp(z).sum()))

    after = qs.descend([(cells, shares)], np.array([1]), np.array([0]), np.ones(2), np.random.default_rng(1), 4, 3, 1e-2, 0.0)
    assert loss(after[0].astype(float), after[1].astype(float)) < loss(vectors, output) < math.log(2)
    assert (before[0][[0, 1, 2]] == after[0][[0, 1, 2]]).all()


def test_quality_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = qs.fit_quality(labels.where(fold("doc_id", 5) != 0), docs)
    rows = qs.score_quality(docs, model).join(labels, "doc_id").where(fold("doc_id", 5) == 0).collect()
    good, bad = [r for r in rows if r.quality == 1], [r for r in rows if r.quality == 0]
    assert len(rows) > 50 and sum(r.predicted for r in good) >= 0.95 * len(good)
    assert sum(r.predicted == 0 for r in bad) >= 0.7 * len(bad)
    assert np.mean([a.score > b.score for a in good for b in bad]) >= 0.95
    assert abs(np.mean([r.score for r in rows]) - len(good) / len(rows)) < 0.05
    again = qs.fit_quality(labels.where(fold("doc_id", 5) != 0).repartition(7), docs.repartition(5))
    assert again.intercept == model.intercept and (again.slopes == model.slopes).all()


def test_quality_of_odd_rows(spark, odd, empty, docs):
    labelled = docs.select("doc_id", "text").withColumn("quality", fold("doc_id", 2).cast("int"))
    model = qs.fit_quality(labelled)
    found = qs.score_quality(odd, model).collect()
    assert len(found) == odd.count() and all(0 <= r.score <= 1 for r in found)
    assert len({r.score for r in found if r.doc_id in (1, 2, 3)}) == 1
    assert len({r.score for r in found if r.doc_id in (4, None)}) == 1
    single = qs.fit_quality(odd)
    assert {r.predicted for r in qs.score_quality(odd, single).collect()} == {1}
    untrained = qs.fit_quality(empty)
    assert {r.predicted for r in qs.score_quality(odd, untrained).collect()} == {0}
    assert qs.score_quality(empty, model).count() == 0


# --- clusters ---


def plain_clusters(rows, settings):
    """Lloyd's rounds with all distances in Python integers: sorted (id, cluster, distance)."""
    import hashlib

    kept = [(i, [math.floor(settings.scale * x) for x in v]) for i, v in rows]
    name = {i: hashlib.sha256(f"{settings.seed}:{i}".encode()).hexdigest() for i, _ in kept if i is not None}
    order = sorted(kept, key=lambda r: (r[0] is None, name.get(r[0], ""), r[1]))
    centroids = [v for _, v in order[: settings.k]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), i) for i, c in enumerate(centroids))

    for _ in range(settings.rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(near(v)[1], []).append(v)
        centroids = [[sum(x) // len(groups[i]) for x in zip(*groups[i])] if i in groups else c for i, c in enumerate(centroids)]
    return sorted(((i, *near(v)[::-1]) for i, v in kept), key=str)


@pytest.mark.parametrize("kind", ["noise", "groups", "grid", "copies"])
def test_clusters_equal_all_distances(spark, kind):
    draw = np.random.default_rng(8)
    v = draw.normal(size=(400, 8))
    if kind == "groups":
        v = 0.01 * v + draw.normal(size=(10, 8))[np.arange(400) % 10]
    elif kind == "grid":  # many ties
        v = np.round(v) / 2
    elif kind == "copies":
        v[::3] = v[0]
    rows = [(i // 2 if i < 20 else i, x.tolist()) for i, x in enumerate(v)]
    settings = pc.ClusterSettings(k=10, rounds=4, dimensions=8)
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    found = pc.cluster_vectors(frame, settings=settings)
    assert sorted(map(tuple, found.rows.collect()), key=str) == plain_clusters(rows, settings)
    assert found.vectors == 400 * settings.rounds
    if kind == "groups":  # bounds spare most distances where there are clusters
        assert found.measured < 0.4 * found.vectors * settings.k


def test_bounds_never_exceed_distances():
    draw = np.random.default_rng(9)
    for scale in (1, 1_000, pc.LARGEST // 8):
        v = (draw.normal(size=(300, 64)) * scale).astype(np.int64)
        centroids, pivots = v[:20], v[20:26]
        nearest = pc.Nearest(centroids, pivots)
        low = nearest.bounds(np.sqrt(np.stack([pc.squared(v, p) for p in pivots], 1).astype(float)))
        exact = np.sqrt(np.stack([pc.squared(v, c) for c in centroids], 1).astype(float))
        assert (low <= exact * (1 + 1e-15)).all() and (low > 0.05 * exact).any()


def test_clusters_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [(None, [3.0, -1.0]), (1, [0.5, 0.25]), (1, [0.5, 0.25]), (2, [-0.001, 2.0])]
    bad = [(3, None), (4, [1.0]), (5, [1.0, None]), (6, [nan, 0.0]), (7, [inf, 0.0]), (8, [1e300, 0.0]), (9, []), (10, [1.0, 2.0, 3.0])]
    rows = [(*r, 5, "x") for r in good + bad]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, cluster int, id string")
    settings = pc.ClusterSettings(k=5, rounds=2, dimensions=2)
    found = pc.cluster_report(frame, settings=settings).collect()
    assert sorted(((r.vec_id, r.cluster, r.distance) for r in found), key=str) == plain_clusters(good, settings)
    assert {r.inertia for r in found} == {sum(r.distance for r in found)}
    none = pc.cluster_report(frame.where("vec_id > 2"), settings=settings)
    assert none.count() == 0 and none.columns == pc.cluster_report(frame, settings=settings).columns


# --- spelling ---


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(texts, rules):
    counts = Counter()
    for doc, text in texts:
        for run in sa.RUN.findall((text or "").translate(sa.TO_LOWER)):
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if rules.drop_one_in and h % rules.drop_one_in == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= rules.min_length and n >= rules.min_count}
    others = {w: sorted((x for x in words if near(w, x)), key=lambda x: (-words[x], x)) for w in words}
    form = {w: x[0] if x and words[x[0]] >= rules.form_ratio * words[w] else None for w, x in others.items()}
    out = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(others[w]), words.get(form[w])))
    return sorted(out)


@pytest.mark.parametrize("most", [5_000, 20, 1])
def test_variants_equal_all_pairs(spark, most):
    draw = np.random.default_rng(most)
    # Few letters and long runs of one of them: edits with many places, hot beginnings and ends.
    words = ["".join(draw.choice(list("aabÀé"), size=int(draw.integers(5, 10)))) for _ in range(250)]
    words += ["aaaaaa", "aaaaaaa", "aaaaaaaa", "aaabaaa", "aaaaaaaab", "baaaaaa"]
    weight = [0, 6, 25, 90]
    texts = [(d, " ".join(draw.choice(words, size=4).tolist() + [words[d % 256]] * weight[d % 4])) for d in range(300)]
    texts.append((1000, "zzchain " * 3 + "zzchains " * 10 + "zzchainss " * 40))
    rules = sa.SpellingRules(drop_one_in=7, min_count=2, form_ratio=2, most_words=most)
    frame = spark.createDataFrame(rows_of([*texts, (None, "AAAAAA-Aaaaaab")]), SCHEMA).repartition(4)
    found = [(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in sa.spelling_variants(frame, rules=rules).collect()]
    truth = plain_variants([*texts, (None, "AAAAAA-Aaaaaab")], rules)
    assert sorted(found) == truth
    assert sum(1 for r in truth if r[1]) > 20 and any(r[2] != (r[1] or r[0]) for r in truth)


def test_acceptor_is_minimal_and_pairs_come_once():
    words = sorted({a + b + c for a in ("x", "y", "") for b in ("kk", "k", "lm") for c in ("s", "t", "ss")})
    acceptor = sa.Acceptor(words)
    found = list(sa.accepted_pairs(acceptor))
    assert len(found) == len({frozenset(p) for p in found})
    assert {frozenset(p) for p in found} == {frozenset((a, b)) for a in words for b in words if near(a, b)}
    reachable, stack = set(), [0]
    while stack:
        state = stack.pop()
        if state not in reachable:
            reachable.add(state)
            stack.extend(acceptor.arcs[state].values())

    def rest(state):
        return frozenset([*([""] if acceptor.final[state] else []), *(c + r for c, to in acceptor.arcs[state].items() for r in rest(to))])

    assert rest(0) == set(words) and len({rest(s) for s in reachable}) == len(reachable)


def test_variants_of_odd_rows(odd, empty):
    rules = sa.SpellingRules(min_count=1, drop_one_in=0)
    found = {r.word: r for r in sa.spelling_variants(odd, rules=rules).collect()}
    assert found["x" * 300_000].n == 1 and found["x" * 300_000].n_near == 0
    assert "plain" not in found and sum(r.n for w, r in found.items() if w.startswith("wörd")) == 200_000
    assert sa.spelling_variants(empty).count() == 0
    assert sa.spelling_variants(odd.where("doc_id < 4")).count() == 0


# --- search on the given vectors ---


def test_partition_search_reaches_its_recall_on_the_given_vectors(spark):
    """Against all inner products, with the registered query; repeated rows and query ids once each."""
    from sembra.llm.queries import op2_partition_search

    found = op2_partition_search(spark, "/root/testdata/sf0.01").collect()
    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()
    ids, vectors = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    met = {}
    for r in found:
        met.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    hit = total = 0
    for i in np.flatnonzero(ids % 20 == 0):
        scores = (vectors * vectors[i]).sum(1)
        best = [j for j in np.lexsort((ids, -scores)) if j != i][:20]
        mine = sorted(met[ids[i]])
        assert [rank for rank, _, _ in mine] == list(range(1, 21))
        assert all(score == scores[ids == v][0] for _, v, score in mine)
        hit, total = hit + len({v for _, v, _ in mine} & set(ids[best].tolist())), total + 20
    assert hit / total >= 0.9


def test_repeated_vectors_and_queries(spark):
    from sembra.llm import partition_search as ps

    rows = [(1, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [1.0, 0.1]), (2, [1.0, 0.1]), (3, [0.0, 1.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in ps.search(frame, frame, 2).collect())
    # Query 1 is searched once, with [0.5, 0.5]; both rows of 2 are candidates.
    assert [f for f in found if f[0] == 1] == [(1, 1, 2, 0.55), (1, 2, 2, 0.55)]
    assert [f[:3] for f in found if f[0] == 3] == [(3, 1, 1), (3, 2, 2)]
