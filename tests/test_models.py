import math
import random
from dataclasses import replace
from pathlib import Path

import numpy as np
import pytest
from conftest import BAR_SCHEMA, day
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tickerloom.operators import classify, clustering, profile, scenarios, silhouette
from tickerloom.operators.splits import LABEL
from tickerloom.params import CLUSTER_FEATURES, Params
from tickerloom.plans import pipeline

SMALL = Params(
    universe=None, benchmark="T0", cluster_restarts=3, sweep_restarts=2, sweep=(2, 3, 4, 99),
    forest_trees=10, boost_rounds=5, boost_rate=0.1,
)
PROFILE_SCHEMA = "ticker string, " + ", ".join(f"{c} double" for c in CLUSTER_FEATURES)


@pytest.fixture(scope="module")
def four_groups(spark):
    """Four well separated risk groups of six tickers each."""
    rng = random.Random(0)
    rows = []
    for group, (ret, vol, sharpe, beta) in enumerate(
        [(0.05, 0.1, 2.0, 0.2), (0.1, 0.4, 1.0, 0.8), (0.2, 0.9, 0.5, 1.5), (0.4, 2.0, -1.0, 3.0)]
    ):
        for i in range(6):
            noise = [rng.uniform(-0.01, 0.01) for _ in range(4)]
            values = [v + e for v, e in zip((ret, vol, sharpe, beta), noise)]
            rows.append((f"G{group}-{i}", *values))
    return spark.createDataFrame(rows, PROFILE_SCHEMA)


def test_clusters_find_the_groups_in_risk_order(four_groups):
    found = clustering.cluster_profiles(four_groups, SMALL)
    labels = {r.ticker: r.cluster_label for r in found.profile.collect()}
    expected = ["Conservative", "Balanced", "Growth", "Aggressive"]
    assert all(labels[f"G{g}-{i}"] == expected[g] for g in range(4) for i in range(6))
    assert found.silhouette > 0.9 and found.silhouette_metric == "euclidean"
    again = clustering.cluster_profiles(four_groups, SMALL)
    assert {r.ticker: r.cluster_id for r in again.profile.collect()} == {
        r.ticker: r.cluster_id for r in found.profile.collect()
    }


def test_new_profiles_are_labelled_and_unknown_ids_named(spark, four_groups, tmp_path):
    found = clustering.cluster_profiles(four_groups, SMALL)
    pipeline.save_model(found.model, str(tmp_path / "model"))
    model = pipeline.load_model(str(tmp_path / "model"))
    new = spark.createDataFrame([("NEW", 0.4, 2.0, -1.0, 3.0)], PROFILE_SCHEMA)
    labelled = clustering.predict_clusters(new, model, found.ranking).first()
    assert labelled.cluster_label == "Aggressive" and labelled.cluster_color == "#EF4444"
    nothing = found.ranking.limit(0)
    assert clustering.predict_clusters(new, model, nothing).first().cluster_label == "Unknown"


def test_sweep_skips_large_k_and_marks_the_best(four_groups):
    rows = clustering.sweep_clusters(four_groups, SMALL).collect()
    assert [r.k for r in rows] == [2, 3, 4]
    assert [r.k for r in rows if r.is_best] == [4]


def test_more_clusters_than_labels_is_an_error(four_groups):
    with pytest.raises(ValueError, match="5 clusters"):
        clustering.cluster_profiles(four_groups, replace(SMALL, clusters=5))


@pytest.mark.parametrize("copies", [1, 40])
def test_the_caller_names_the_metric_at_any_size(four_groups, copies):
    many = four_groups.withColumn("_n", F.explode(F.sequence(F.lit(1), F.lit(copies))))
    many = many.withColumn("ticker", F.concat("ticker", F.lit("-"), "_n")).drop("_n")
    for metric in ("euclidean", "squared_euclidean"):
        found = clustering.cluster_profiles(many, replace(SMALL, silhouette_metric=metric))
        assert found.silhouette_metric == metric and found.silhouette > 0.9
    with pytest.raises(ValueError, match="cosine"):
        clustering.cluster_profiles(four_groups, replace(SMALL, silhouette_metric="cosine"))


def test_rank_clips_beta_and_sharpe(spark):
    rows = [("A", 0.0, 1.0, 9.0, -2.0, 0), ("B", 0.0, 1.0, -9.0, 0.5, 1), ("C", 0.0, 0.1, 0.0, 0.0, 7)]
    table = spark.createDataFrame(rows, PROFILE_SCHEMA + ", cluster_id int")
    ranked = {r.cluster_id: r for r in profile.rank_clusters(table).collect()}
    assert math.isclose(ranked[0].risk_score, 1.0 - 1.5)
    assert math.isclose(ranked[1].risk_score, 1.5 + 0.6)
    assert [ranked[i].cluster_label for i in (0, 7, 1)] == ["Conservative", "Balanced", "Growth"]
    report = profile.label_report(profile.attach_labels(table, profile.rank_clusters(table)))
    assert [(r.cluster_label, r.tickers) for r in report.collect()] == [
        ("Conservative", 1), ("Balanced", 1), ("Growth", 1), ("Aggressive", 0)
    ]
    sizes = {r.ticker: r.plot_size for r in profile.plot_sizes(table).collect()}
    assert sizes == {"A": 9.0, "B": 0.1, "C": 0.1}


def test_standardize_uses_population_deviation_and_survives_constants(spark):
    table = spark.createDataFrame([("A", 1.0, 5.0), ("B", 3.0, 5.0)], "t string, x double, y double")
    rows = profile.standardize(table, ("x", "y")).orderBy("t").collect()
    assert [(r.x, r.y) for r in rows] == [(-1.0, 0.0), (1.0, 0.0)]
    other = spark.createDataFrame([("C", 7.0, 6.0)], table.schema)
    assert profile.standardize(other, ("x", "y"), table).first()[1:] == (5.0, 1.0)


def brute_silhouette(vectors, labels, squared=False):
    d = np.linalg.norm(vectors[:, None] - vectors[None, :], axis=2)
    d = d**2 if squared else d
    out = []
    for i, own in enumerate(labels):
        mates = (labels == own) & (np.arange(len(labels)) != i)
        if not mates.any():
            out.append(0.0)
            continue
        a = d[i, mates].mean()
        b = min(d[i, labels == c].mean() for c in set(labels) if c != own)
        out.append((b - a) / max(a, b))
    return np.array(out)


@pytest.mark.parametrize("block_rows", [7, 8192])
def test_exact_silhouette_equals_brute_force(spark, block_rows):
    rng = np.random.default_rng(0)
    vectors = rng.normal(size=(60, 3))
    labels = rng.integers(0, 4, size=60)
    labels[0] = 9
    rows = [(f"p{i:02}", int(c), v.tolist()) for i, (c, v) in enumerate(zip(labels, vectors))]
    points = spark.createDataFrame(rows, "id string, cluster int, vector array<double>")
    samples = silhouette.silhouette_samples(points, block_rows).orderBy("id").collect()
    assert np.allclose([r.silhouette for r in samples], brute_silhouette(vectors, labels))
    mean = silhouette.silhouette_exact(points, block_rows).first().silhouette
    assert math.isclose(mean, brute_silhouette(vectors, labels).mean(), abs_tol=1e-12)
    squared = silhouette.silhouette_squared(points)
    assert math.isclose(squared, brute_silhouette(vectors, labels, True).mean(), abs_tol=1e-9)


def hard_vectors(name, rng):
    plain = rng.normal(size=(90, 5))
    rare = rng.random((90, 5)) < 0.01
    return {
        "plain": plain, "far from zero": plain + 1e6, "copies": np.repeat(plain[:9], 10, 0),
        "near copies": np.repeat(plain[:9], 10, 0) + 1e-9 * plain,
        "nan": np.where(rare, np.nan, plain), "infinite": np.where(rare, np.inf, plain),
        "huge": plain * 1e200, "tiny": plain * 1e-200, "empty": plain[:, :0],
        "mixed": plain * 10.0 ** rng.integers(-8, 8, (90, 1)),
    }[name]


@pytest.mark.parametrize("tile", [512, 13])
@pytest.mark.parametrize("name", [
    "plain", "far from zero", "copies", "near copies", "nan", "infinite", "huge", "tiny", "empty",
    "mixed",
])
def test_products_lose_no_digits(monkeypatch, name, tile):
    """Sums of distances by matrix products are those of the differences."""
    monkeypatch.setattr(silhouette, "TILE_COLUMNS", tile)
    rng = np.random.default_rng(2)
    vectors, members = hard_vectors(name, rng), np.eye(3)[rng.integers(0, 3, 90)]
    a, b, of_a, of_b = vectors[:40], vectors[40:], members[:40], members[40:]
    with np.errstate(all="ignore"):
        apart = np.sqrt(((a[:, None] - b[None]) ** 2).sum(2))
        expected = apart @ of_b, apart.T @ of_a
    for mine, theirs in zip(silhouette._block_totals(a, of_a, b, of_b), expected):
        assert np.allclose(mine, theirs, rtol=1e-10, atol=0, equal_nan=True)


def test_plain_tiles_take_no_differences(monkeypatch):
    """Only close pairs go by differences, whose price was 64 passes over every pair."""
    taken, found = [], np.nonzero
    monkeypatch.setattr(np, "nonzero", lambda near: taken.append(near.sum()) or found(near))
    vectors = np.random.default_rng(3).normal(size=(1000, 64))
    vectors[999] = vectors[0] + 1e-9
    silhouette._block_totals(vectors[:500], np.ones((500, 1)), vectors[500:], np.ones((500, 1)))
    assert taken == [1]


def test_blocks_are_large_but_bounded():
    count = silhouette._block_count
    assert count(600_000, 64, silhouette.BLOCK_ROWS) == 19  # 74 of 8,192 rows before
    assert count(600_000, 640, silhouette.BLOCK_ROWS) > 180  # bounded in bytes
    assert count(100_000, 64, silhouette.BLOCK_ROWS) == 16 and count(0, 0, 1) == 1


@pytest.mark.parametrize("block_rows", [7, 8192])
def test_one_pass_scores_many_clusterings(spark, block_rows):
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(50, 2))
    several = [rng.integers(0, k, size=50) for k in (2, 5, 7)]
    several[2][several[2] == 3] = 4  # a cluster without points
    rows = [
        (f"p{i:02}", [int(c[i]) for c in several], v.tolist()) for i, v in enumerate(vectors)
    ]
    points = spark.createDataFrame(rows, "id string, clusters array<int>, vector array<double>")
    found = silhouette.silhouettes(points, [2, 5, 7], block_rows).orderBy("id").collect()
    for place, labels in enumerate(several):
        expected = brute_silhouette(vectors, labels)
        assert np.allclose([r.silhouettes[place] for r in found], expected)


def test_swept_scores_are_the_exact_ones(spark, four_groups):
    """One loop and one pass give every k the score of a clustering of its own."""
    params = replace(SMALL, sweep=(2, 3, 4, 5))
    swept = clustering.cluster_profiles(four_groups, params, sweep=True).sweep.collect()
    for row in swept:
        alone = clustering.sweep_clusters(four_groups, replace(params, sweep=(row.k,))).first()
        assert (alone.k, alone.silhouette) == (row.k, row.silhouette)


def test_restarts_reach_the_lowest_cost_of_separate_fits(spark, four_groups):
    scaler = clustering.fit_scaler(four_groups)
    scaled = scaler.transform(four_groups).cache()
    vectors = scaled.select("ticker", vector_to_array("_scaled").alias("vector"))
    wanted = [(k, seed) for k in (3, 4) for seed in range(6)]
    found = clustering.fit_centers(vectors, wanted, 100)
    for k in (3, 4):
        own = min(c.cost for c in found if c.k == k)
        fits = [
            KMeans(featuresCol="_scaled", k=k, maxIter=100, seed=s).fit(scaled) for s in range(6)
        ]
        assert own <= min(m.summary.trainingCost for m in fits) * (1 + 1e-6)
    model = clustering.as_model(next(c for c in found if c.k == 4).points, spark)
    points = np.sort(np.array(model.clusterCenters()), axis=0)
    assert np.allclose(points, np.sort(next(c for c in found if c.k == 4).points, axis=0))


def test_one_job_per_round(spark, four_groups, monkeypatch):
    rounds = []
    once = clustering._round
    monkeypatch.setattr(
        clustering, "_round", lambda *args: rounds.append(len(args[1])) or once(*args)
    )
    clustering.cluster_profiles(four_groups, replace(SMALL, cluster_restarts=9), sweep=True)
    assert rounds[0] == 9 + 2 * 2 and len(rounds) < 12  # all sets in every round, few rounds


def test_equal_profiles_have_fewer_clusters(spark):
    rows = [(f"T{i}", 1.0, 1.0, 1.0, 1.0) for i in range(5)] + [("X", 2.0, 2.0, 2.0, 2.0)]
    found = clustering.cluster_profiles(spark.createDataFrame(rows, PROFILE_SCHEMA), SMALL)
    ids = {r.ticker: r.cluster_id for r in found.profile.collect()}
    assert len(set(ids.values())) == 2 and len({ids[f"T{i}"] for i in range(5)}) == 1


@pytest.fixture(scope="module")
def planted(spark):
    """Rows whose label follows one predictor."""
    rng = random.Random(3)
    rows = []
    for t in range(10):
        for d in range(80):
            values = [rng.gauss(0, 1) for _ in SMALL.predictors]
            label = int(values[7] + rng.gauss(0, 0.2) > 0)
            rows.append((f"T{t}", day(d), *values, label))
    schema = "ticker string, date date, " + ", ".join(f"{c} double" for c in SMALL.predictors)
    return spark.createDataFrame(rows, f"{schema}, {LABEL} int")


def test_predictor_finds_the_planted_signal(planted):
    found = classify.train_predictor(planted, SMALL)
    assert found.winner in classify.CONTENDERS
    assert found.accuracy > 0.85 > found.baseline and found.cv_accuracy > 0.85
    assert (found.n_train, found.n_test) == (640, 160)
    importances = found.importances.collect()
    assert importances[0].feature == SMALL.predictors[7] and len(importances) == 19
    assert math.isclose(sum(r.importance for r in importances), 1.0, abs_tol=1e-9)
    values = [r.importance for r in importances]
    assert values == sorted(values, reverse=True)


@pytest.mark.parametrize("name", classify.CONTENDERS)
def test_training_does_not_depend_on_the_layout(planted, name):
    params = replace(SMALL, fit_partitions=5)
    results = []
    for table in (planted.coalesce(1), planted.repartition(7), planted.orderBy(F.rand(1))):
        train, test = classify.split_rows(table, params)
        scored = classify.score_rows(test, classify.fit_contender(train, name, params), params)
        rows = scored.select("ticker", "date", "probability_up").collect()
        results.append(sorted(map(tuple, rows)))
    assert results[0] == results[1] == results[2]


def test_an_empty_fold_is_an_error(planted):
    few = planted.orderBy("date", "ticker").limit(6)
    train, _ = classify.split_rows(few, replace(SMALL, test_share=0.0, folds=50))
    with pytest.raises(ValueError, match="has no rows"):
        classify.cross_validate(train, classify.FOREST, replace(SMALL, folds=50))


def test_the_cut_reaches_the_scan_and_can_leave_a_gap(planted):
    train, test = classify.split_rows(planted, SMALL)
    assert train.count() + test.count() == planted.count()
    plan = test._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [" in plan and "GreaterThanOrEqual(date," in plan
    first = test.agg(F.min("date")).first()[0]
    gapped, same = classify.split_rows(planted, replace(SMALL, gap_days=5))
    assert same.count() == test.count()
    assert (first - gapped.agg(F.max("date")).first()[0]).days == 6


def test_scoring_reads_missing_predictors_as_zero(planted):
    train, test = classify.split_rows(planted, SMALL)
    model = classify.fit_contender(train, classify.BOOSTED, SMALL)
    zeroed = test.withColumns({"ma7": F.lit(0.0), "rsi": F.lit(0.0)})
    partial = test.drop("ma7").withColumn("rsi", F.lit(None).cast("double"))

    def probabilities(rows):
        scored = classify.score_rows(rows, model, SMALL).orderBy("ticker", "date").collect()
        return [(r.prediction, r.probability_up) for r in scored]

    assert probabilities(partial) == probabilities(zeroed)
    assert all(0.0 <= p <= 1.0 and c in (0.0, 1.0) for c, p in probabilities(test))


def test_scenarios_cover_every_combination(spark):
    base = spark.createDataFrame(
        [("A", day(0), 0.3, None, -1.0)],
        "ticker string, date date, beta double, volatility double, ma7 double",
    )
    rows = scenarios.scenario_rows(
        base, {"ma_spread": (-0.1, 0.0, 0.1), "rsi_binned": (0, 2)}, SMALL
    ).collect()
    assert len(rows) == 6
    assert {(r.ma_spread, r.ma_cross_signal) for r in rows} == {(-0.1, -1.0), (0.0, -1.0), (0.1, 1.0)}
    assert {(r.beta, r.volatility, r.ma7, r.rsi, r.volume_ma20, r.day_of_week) for r in rows} == {
        (0.3, 0.25, 150.0, 50.0, 1_000_000.0, 2.0)
    }
    with pytest.raises(ValueError, match="rsi"):
        scenarios.scenario_rows(base, {"rsi": (1.0,)}, SMALL)


def test_latest_rows_take_the_last_bar(make_bars):
    rows = scenarios.latest_rows(make_bars({"AAA": [1.0, 2.0, 3.0], "BBB": [9.0]})).collect()
    assert {(r.ticker, r.date, r.close) for r in rows} == {("AAA", day(2), 3.0), ("BBB", day(0), 9.0)}


def test_pipeline_end_to_end(spark, tmp_path):
    rng = random.Random(11)
    rows = []
    for t in range(8):
        price = 100.0
        for d in range(120):
            price = 100.0 + (price - 100.0) * 0.5 + rng.gauss(0, 2 + t)
            row = (f"T{t}", day(d), price, price + 1, price - 1, price, rng.randrange(1, 99))
            rows += [row, row] if d % 9 == 0 else [row]
    raw = spark.createDataFrame(rows, BAR_SCHEMA)
    scratch = Path(spark.conf.get("spark.checkpoint.dir")) / "tickerloom"
    before = set(scratch.glob("*"))
    summary = pipeline.run_pipeline(raw, str(tmp_path / "run"), SMALL).first()
    assert not set(scratch.glob("*")) - before  # the run removed what it needed on the way
    folder = pipeline.Folder(str(tmp_path / "run"))
    saved = pipeline.read_summary(spark, folder).first()
    assert saved == summary and saved.tickers_processed == 8
    assert sum(saved.clustering.distribution.values()) == 8
    assert 0.0 <= saved.return_prediction.accuracy <= 1.0
    clean = spark.read.parquet(folder.clean)
    assert clean.count() == 8 * 120
    removed = pipeline.read_removed(spark, folder).first()
    assert (removed.rows_in, removed.duplicate_rows) == (len(rows), len(rows) - 8 * 120)
    swept = pipeline.read_sweep(spark, folder).collect()
    assert sorted(r.k for r in swept) == [2, 3, 4] and sum(r.is_best for r in swept) == 1
    report = {r.scope: r.support for r in pipeline.read_report(spark, folder).collect()}
    assert report["macro avg"] == report["weighted avg"] > 0
    features = spark.read.parquet(folder.features)
    assert set(features.columns) == set(SMALL.feature_columns) and features.count() == 8 * 120
    exported = spark.read.option("header", True).csv(folder.features_csv)
    assert exported.count() == 8 * 120 and tuple(exported.columns) == SMALL.feature_columns
    clusters = pipeline.read_clusters(spark, folder)
    assert clusters.count() == 8 and clusters.filter("cluster_label is null").isEmpty()
    unlabelled = clusters.drop("cluster_id", "cluster_label", "cluster_color")
    relabelled = pipeline.label_profiles(unlabelled, folder)
    assert {r.ticker: r.cluster_label for r in relabelled.collect()} == {
        r.ticker: r.cluster_label for r in clusters.collect()
    }
    rising = pipeline.read_importances(spark, folder, ascending=True).collect()
    assert len(rising) == 19 and rising[0].importance <= rising[-1].importance
    assert pipeline.predict_direction(features, folder, SMALL).count() == 8 * 120
    assert len(pipeline.load_model(folder.cluster_model).stages) == 3
