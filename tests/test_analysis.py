import numpy as np
import pytest

from sembra.operators import analysis as an


def test_threshold_curve_edges(spark):
    rows = [(True, 0.61), (True, 0.6), (True, 0.3), (False, 0.6), (False, 0.97)]
    scored = spark.createDataFrame(rows, "same boolean, similarity double")
    sweep = {round(r["tau"], 2): r for r in an.threshold_sweep(scored).collect()}
    assert len(sweep) == 49 and min(sweep) == 0.5 and max(sweep) == 0.98
    at = sweep[0.6]
    assert (at["tp"], at["fp"], at["fn"]) == (2, 2, 1)
    assert at["precision"] == 0.5 and at["recall"] == pytest.approx(2 / 3)
    assert sweep[0.98]["precision"] == 1.0 and sweep[0.98]["recall"] == 0.0 and sweep[0.98]["f1"] == 0.0
    assert an.best_threshold(an.threshold_sweep(scored)).first()["tau"] == 0.5


def test_threshold_curve_without_same_pairs(spark):
    scored = spark.createDataFrame([(False, 0.7)], "same boolean, similarity double")
    rows = an.threshold_sweep(scored).collect()
    assert all(r["recall"] == 0.0 and r["f1"] == 0.0 for r in rows)


def test_histogram_matches_numpy(spark):
    values = np.random.RandomState(3).gamma(2.0, size=3_000)
    df = spark.createDataFrame([(float(v),) for v in values], "entropy double")
    bins = an.entropy_histogram(df).orderBy("bin").collect()
    counts, edges = np.histogram(values, bins=50)
    assert [r["n"] for r in bins] == counts.tolist()
    assert [r["bin_start"] for r in bins] == pytest.approx(edges[:-1].tolist())
    flat = spark.createDataFrame([(2.0,)] * 4, "entropy double")
    assert sum(r["n"] for r in an.entropy_histogram(flat).collect()) == 4


def test_density_integrates_to_one(spark):
    rng = np.random.RandomState(1)
    rows = [(bool(s), float(v)) for s, v in zip(rng.rand(500) < 0.8, rng.randn(500))]
    bins = an.similarity_density(spark.createDataFrame(rows, "same boolean, similarity double"), 20).collect()
    for same in (True, False):
        own = sorted((r["bin_start"], r["density"]) for r in bins if r["same"] == same)
        width = own[1][0] - own[0][0]
        assert len(own) == 20 and sum(d for _, d in own) * width == pytest.approx(1.0)


def test_pairs_are_distinct_and_of_the_right_kind(spark):
    rows = [(i, "hot" if i % 3 else f"c{i % 5}") for i in range(300)] + [(999, "single")]
    df = spark.createDataFrame(rows, "doc_id long, category string")
    category = dict(rows)
    pairs = an.sample_pairs(df, 200).collect()
    assert all(r["a"] != r["b"] for r in pairs)
    assert all((category[r["a"]] == category[r["b"]]) == r["same"] for r in pairs)
    same = [category[r["a"]] for r in pairs if r["same"]]
    assert 150 < len(same) <= 200 and len(set(same)) == 6 and "single" not in same
    assert pairs == an.sample_pairs(df, 200).collect() or sorted(pairs) == sorted(an.sample_pairs(df, 200).collect())


def test_cooccurrence_has_zero_cells(spark):
    df = spark.createDataFrame([(0, "a"), (0, "a"), (2, "b")], "cluster int, category string")
    cells = {(r["cluster"], r["category"]): r["n"] for r in an.cooccurrence(df, 3).collect()}
    assert len(cells) == 6 and cells[0, "a"] == 2 and cells[1, "b"] == 0
    shares = {(r["cluster"], r["category"]): r["share"] for r in an.cooccurrence_normalized(df, 3).collect()}
    assert shares[0, "a"] == 1.0 and shares[2, "b"] == 1.0 and shares[2, "a"] == 0.0


def test_summary_uses_short_names(spark):
    rows = [(1, "rec.autos")] * 3 + [(1, "sci.space")] * 3 + [(1, "x")] + [(1, "y")] * 2
    summary = an.cluster_summary(spark.createDataFrame(rows, "cluster int, category string")).collect()
    assert summary[0]["size"] == 9 and summary[0]["top_categories"] == "autos(3), space(3), y(2)"


def test_paraphrase_report(spark):
    queries = spark.createDataFrame(
        [(1, [1.0, 0.0], 0), (2, [0.6, 0.8], 0), (3, [0.65, 0.7599342], 1)],
        "qid long, embedding array<double>, dominant_cluster int",
    )
    pairs = spark.createDataFrame([(1, 1, 2), (2, 1, 3)], "pair_id long, q1 long, q2 long")
    rows = {r["pair_id"]: r for r in an.paraphrase_report(pairs, queries).collect()}
    assert rows[1]["same_cluster"] and rows[1]["hit_at_060"] and not rows[1]["hit_at_065"]
    assert not rows[2]["same_cluster"] and rows[2]["hit_at_065"] and not rows[2]["hit_at_070"]
