import hashlib
import random

import numpy as np
import pandas as pd
import pytest
from conftest import day
from pyspark.sql import functions as F

from tickerloom.operators import metrics, splits
from tickerloom.params import Params


def make_rows(spark, tickers, days, seed=0, missing=0.2):
    rng = random.Random(seed)
    rows = [
        (f"T{t}", day(d), rng.randrange(2))
        for t in range(tickers) for d in range(days) if rng.random() >= missing
    ]
    return spark.createDataFrame(rows, "ticker string, date date, is_profitable int")


def in_order(rows):
    pdf = rows.toPandas()
    pdf["digest"] = [hashlib.md5(t.encode()).hexdigest() for t in pdf.ticker]
    return pdf.sort_values(["date", "digest"]).reset_index(drop=True)


@pytest.mark.parametrize(("tickers", "days"), [(40, 30), (300, 1), (1, 50), (2, 2), (1, 1)])
@pytest.mark.parametrize("share", [0.2, 0.37])
def test_walk_forward_equals_a_full_sort(spark, tickers, days, share):
    rows = make_rows(spark, tickers, days, seed=tickers, missing=0.1 if days > 2 else 0.0)
    params = Params(test_share=share)
    pdf = in_order(splits.walk_forward(rows, params))
    train = int(len(pdf) * (1 - share))
    assert pdf.is_test.tolist() == [0] * train + [1] * (len(pdf) - train)


@pytest.mark.parametrize(("tickers", "days"), [(30, 40), (200, 1), (3, 2), (2, 1), (1, 1)])
def test_folds_equal_a_ranking_per_class(spark, tickers, days):
    rows = make_rows(spark, tickers, days, seed=days, missing=0.0)
    pdf = in_order(splits.cv_folds(rows, Params()))
    for _, group in pdf.groupby("is_profitable"):
        n = len(group)
        assert group.fold.tolist() == [rank * 5 // n for rank in range(n)]


def test_split_of_no_rows(spark):
    rows = make_rows(spark, 1, 1, missing=0.0).limit(0)
    assert splits.walk_forward(rows, Params()).count() == 0


def test_ml_rows_need_every_predictor_and_a_target(spark):
    params = Params(model_columns=("a", "b"))
    features = spark.createDataFrame(
        [("A", day(0), 1.0, 1.0, 0.1), ("A", day(1), None, 1.0, 0.1), ("A", day(2), 1.0, 1.0, None),
         ("A", day(3), 1.0, 1.0, 0.0), ("A", day(4), 1.0, 1.0, -0.1)],
        "ticker string, date date, a double, b double, forward_return double",
    )
    rows = splits.ml_rows(features, params).orderBy("date").collect()
    assert [(r.date, r.is_profitable) for r in rows] == [(day(0), 1), (day(3), 0), (day(4), 0)]
    assert splits.ml_rows(features, params).columns == ["ticker", "date", "a", "b", "is_profitable"]
    with pytest.raises(ValueError, match="'b'"):
        splits.ml_rows(features.drop("b"), params)


def test_class_weights_balance(spark):
    rows = make_rows(spark, 20, 20, seed=4)
    weighted = splits.with_class_weights(rows)
    sums = {r.is_profitable: r.w for r in
            weighted.groupBy("is_profitable").agg(F.sum("weight").alias("w")).collect()}
    assert abs(sums[0] - rows.count() / 2) < 1e-6 and abs(sums[1] - sums[0]) < 1e-6


def scored(spark, pairs):
    return spark.createDataFrame(pairs, "is_profitable int, prediction double")


def test_report_against_hand_counts(spark):
    pairs = [(1, 1.0)] * 6 + [(1, 0.0)] * 2 + [(0, 1.0)] * 3 + [(0, 0.0)] * 9
    rows = {r.scope: r for r in metrics.classification_report(scored(spark, pairs)).collect()}
    assert set(rows) == {"0", "1", "macro avg", "weighted avg"}
    assert rows["1"].precision == 6 / 9 and rows["1"].recall == 6 / 8 and rows["1"].support == 8
    assert rows["0"].precision == 9 / 11 and rows["0"].recall == 9 / 12
    assert np.isclose(rows["macro avg"].recall, (6 / 8 + 9 / 12) / 2)
    f1 = {c: 2 * rows[c].precision * rows[c].recall / (rows[c].precision + rows[c].recall)
          for c in "01"}
    assert np.isclose(rows["weighted avg"].f1_score, (f1["0"] * 12 + f1["1"] * 8) / 20)
    assert {r.accuracy for r in rows.values()} == {15 / 20}
    one = metrics.scores(scored(spark, pairs)).first()
    assert one.accuracy == 0.75 and np.isclose(one.f1_score, f1["1"])


def test_scores_when_a_class_never_occurs(spark):
    one = metrics.scores(scored(spark, [(0, 0.0)] * 4)).first()
    assert (one.accuracy, one.f1_score) == (1.0, 0.0)
    rows = {r.scope: r for r in
            metrics.classification_report(scored(spark, [(0, 1.0), (0, 1.0)])).collect()}
    assert rows["0"].recall == 0.0 and rows["1"].support == 0 and rows["1"].precision == 0.0


@pytest.mark.parametrize(
    ("accuracies", "winner"), [((0.5, 0.6), "second"), ((0.6, 0.6), "first"), ((0.7, 0.6), "first")]
)
def test_winner_must_be_strictly_better(spark, accuracies, winner):
    results = spark.createDataFrame(
        [("second", 1, accuracies[1]), ("first", 0, accuracies[0])],
        "contender string, priority int, accuracy double",
    )
    assert metrics.pick_winner(results).first().contender == winner


def test_baseline(spark):
    row = metrics.baseline_accuracy(scored(spark, [(1, 0.0), (1, 0.0), (0, 0.0), (1, 1.0)])).first()
    assert (row.baseline_accuracy, row.rows) == (0.75, 4)


def test_fold_sizes_differ_by_at_most_one(spark):
    folds = splits.cv_folds(make_rows(spark, 23, 17, seed=2), Params())
    sizes = folds.groupBy("is_profitable", "fold").count().toPandas()
    for _, group in sizes.groupby("is_profitable"):
        assert len(group) == 5 and group["count"].max() - group["count"].min() <= 1
    assert isinstance(sizes, pd.DataFrame)
