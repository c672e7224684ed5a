from __future__ import annotations

import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pacewise.operators import backtest, drift, ranks, sketches


def rows_of_days(seed=1, days=30):
    rng = random.Random(seed)
    out = []
    for d in range(days):
        for ad in range(rng.randint(3, 9)):
            x, z = rng.gauss(1e6, 3), rng.random()
            out.append((dt.date(2024, 8, 1) + dt.timedelta(d), f"A{ad}", x, z, 2 * x - 5 * z + rng.gauss(0, 0.3)))
    return out


SCHEMA = "date date, ad_set_id string, x double, z double, y double"
PLAN = backtest.Backtest(("x", "z"), "y", folds=4, horizon=3, width=6)


def plain_fold(rows, fold, kind):
    last = max(r[0] for r in rows)
    stop = last - dt.timedelta((PLAN.folds - fold) * PLAN.horizon)
    train = [r for r in rows if r[0] <= stop and (kind == "expanding" or r[0] > stop - dt.timedelta(PLAN.width))]
    test = [r for r in rows if stop < r[0] <= stop + dt.timedelta(PLAN.horizon)]
    design = np.array([[1, r[2] - 1e6, r[3]] for r in train])
    w = np.linalg.lstsq(design, np.array([r[4] for r in train]), rcond=None)[0]
    error = np.array([r[4] - w @ [1, r[2] - 1e6, r[3]] for r in test])
    y = np.array([r[4] for r in test])
    return len(train), len(test), np.abs(error).mean(), 1 - (error**2).sum() / ((y - y.mean()) ** 2).sum()


def test_folds_are_solved_as_least_squares(spark):
    rows = rows_of_days()
    odd = [(None, "N", 1.0, 1.0, 1.0), (rows[3][0], "N", None, 1.0, 1.0), (rows[5][0], "N", 1.0, float("nan"), 1.0),
           (rows[5][0], "N", float("inf"), 1.0, 1.0)]
    got = backtest.fold_metrics(spark.createDataFrame(rows + odd, SCHEMA), PLAN).collect()
    assert len(got) == 8
    for r in got:
        n, tested, mae, r2 = plain_fold(rows, r.fold, r.kind)
        assert (r.train_n, r.n) == (n, tested)
        assert r.mae == pytest.approx(mae, rel=1e-6) and r.r2 == pytest.approx(r2, rel=1e-6)


def test_no_row_is_repeated_for_a_fold(spark):
    df = spark.createDataFrame(rows_of_days(), SCHEMA)
    predicted = backtest.fold_predictions(df, PLAN, backtest.fold_models(df, PLAN))
    assert predicted.count() == sum(1 for r in rows_of_days() if r[0] > dt.date(2024, 8, 18))


def test_constant_and_doubled_features(spark):
    rows = [(dt.date(2024, 8, 1 + i % 20), "A", float(i % 7), 3.0, 2.0 * (i % 7) + 1) for i in range(200)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("w", F.col("x") * 2)
    plan = backtest.Backtest(("x", "z", "w"), "y", folds=2, horizon=4, width=5)
    assert all(r.mae < 1e-6 for r in backtest.fold_metrics(df, plan).collect())
    ridge = backtest.Backtest(("x",), "y", folds=1, horizon=4, ridge=1.0)
    assert backtest.fold_models(df, ridge).first().weights[1] == pytest.approx(1.0)


def test_short_and_empty_histories(spark):
    df = spark.createDataFrame(rows_of_days(days=5), SCHEMA)
    got = {(r.fold, r.kind): r for r in backtest.fold_metrics(df, PLAN).collect()}
    assert set(got) == {(3, "expanding"), (3, "rolling")}
    assert backtest.fold_metrics(df.limit(0), PLAN).collect() == []
    assert backtest.fold_predictions(df.limit(0), PLAN, backtest.fold_models(df.limit(0), PLAN)).collect() == []


def scored(spark, gain):
    rng = random.Random(3)
    rows = []
    for d in range(40):
        for _ in range(10):
            y = rng.gauss(0, 1)
            rows.append((dt.date(2024, 8, 1) + dt.timedelta(d), y, y + rng.gauss(0, 1), y + rng.gauss(0, 1 + gain)))
    rows += [(None, 1.0, 1.0, 1.0), (dt.date(2024, 8, 1), 1.0, None, 1.0)]
    return spark.createDataFrame(rows, "date date, y double, model double, base double")


def test_paired_errors_find_a_gain_and_no_gain(spark):
    better = backtest.paired_errors(scored(spark, 0.5), "y", "model", "base").first()
    assert better.days == 40 and better.pairs == 400 and better.better and better.low < better.gain < better.high
    same = backtest.paired_errors(scored(spark, 0.0), "y", "model", "base").first()
    assert not same.better and same.low < 0 < same.high
    again = backtest.paired_errors(scored(spark, 0.5).repartition(7), "y", "model", "base").first()
    assert again.low == pytest.approx(better.low) and again.high == pytest.approx(better.high)
    none = backtest.paired_errors(scored(spark, 0.0).limit(0), "y", "model", "base").first()
    assert none.pairs == 0 and none.gain is None and none.better is None


def test_weights_are_those_of_chance(spark):
    drawn = spark.range(20_000).select(backtest.block_weight(F.col("id"), F.lit("d")).alias("w"))
    counts = {r.w: r["count"] / 20_000 for r in drawn.groupBy("w").count().collect()}
    for k in range(4):
        assert counts[k] == pytest.approx(math.exp(-1) / math.factorial(k), abs=0.012)


def test_quantiles_of_many_columns(spark):
    rng = np.random.default_rng(2)
    a, b = rng.normal(size=999), rng.integers(0, 4, 999).astype(float)
    rows = [(float(x), float(y), None, "t") for x, y in zip(a, b)] + [(None, float("nan"), None, None)] * 9
    df = spark.createDataFrame(rows, "a double, b double, c double, d string")
    probs = [0.0, 0.1, 0.5, 0.9, 1.0]
    got = {r.column_name: r for r in ranks.exact_quantiles_of(df, ["a", "b", "c"], probs).collect()}
    for name, values in (("a", a), ("b", b)):
        assert got[name].n == 999
        assert got[name].quantiles == pytest.approx(np.quantile(values, probs).tolist(), rel=1e-12)
    assert got["c"].n == 0 and got["c"].quantiles is None


def test_quantiles_of_columns_take_one_range_partitioning(spark):
    df = spark.range(500).selectExpr(*[f"double(id % {k}) AS c{k}" for k in range(2, 12)])
    found = ranks.exact_quantiles_of(df, df.columns, [0.5])
    plan = found._jdf.queryExecution().toString()
    assert plan.count("rangepartitioning") <= 1 and found.count() == 10


def test_drift(spark):
    rng = np.random.default_rng(4)
    train = spark.createDataFrame([(float(x), float(x), 1.0, None) for x in rng.normal(size=2000)], "a double, b double, c double, e double")
    same = [(float(x), float(x) + 1, None if i % 2 else 1.0, 1.0) for i, x in enumerate(rng.normal(size=1500))]
    known = drift.profile(train, ["a", "b", "c", "e"])
    profiled = {r.column_name: r for r in known.collect()}
    assert profiled["a"].counts == [200] * 10 and profiled["c"].edges == [1.0] and profiled["c"].counts == [2000, 0]
    got = {r.column_name: r for r in drift.compared(known, spark.createDataFrame(same, train.schema)).collect()}
    assert not got["a"].alert and got["a"].psi < 0.05 and got["a"].ks < 0.06
    assert got["b"].alert and got["b"].psi > 0.5 and 0.3 < got["b"].ks < 0.5
    assert got["c"].alert and got["c"].psi == 0 and got["c"].null_share_since == 0.5
    assert got["e"].alert and got["e"].psi is None and got["e"].n_before == 0
    a, b = np.array([r.a for r in train.collect()]), np.array([r[0] for r in same])
    edges = np.quantile(a, np.arange(1, 10) / 10)
    p, q = (np.bincount((edges[None] < v[:, None]).sum(1), minlength=10) / len(v) for v in (a, b))
    assert got["a"].psi == pytest.approx(((q - p) * np.log(q / p)).sum())
    assert got["a"].ks == pytest.approx(np.abs(np.cumsum(p) - np.cumsum(q)).max())


def test_drift_of_empty_frames(spark):
    df = spark.createDataFrame([(1.0,), (2.0,)], "a double")
    empty = drift.compared(drift.profile(df, ["a"]), df.limit(0)).first()
    assert empty.alert and empty.n_since == 0 and empty.ks is None and empty.null_share_since is None
    nothing = drift.compared(drift.profile(df.limit(0), ["a"]), df.limit(0)).first()
    assert not nothing.alert and nothing.psi is None


def test_sketches_of_days_merge_over_any_range(spark):
    df = spark.range(60_000).selectExpr(
        "date_add(DATE'2024-01-01', CAST(id % 30 AS INT)) AS date", "double(pmod(id * 7919, 60000)) AS v",
        "IF(id % 3 = 0, NULL, double(id % 5)) AS w", "CAST(NULL AS DOUBLE) AS none",
    )
    stored = sketches.daily_sketches(df, ["v", "w", "none"])
    assert stored.count() == 90
    since, until = F.lit(dt.date(2024, 1, 5)), F.lit(dt.date(2024, 1, 14))
    got = {(r.column_name, r.prob): r for r in sketches.quantiles(sketches.merged(stored, since, until), [0.1, 0.5, 0.9]).collect()}
    part = np.sort([r.v for r in df.where(F.col("date").between(since, until)).select("v").collect()])
    for p in (0.1, 0.5, 0.9):
        assert got["v", p].n == len(part) == 20_000
        assert abs(np.searchsorted(part, got["v", p].quantile) / len(part) - p) < 3 * sketches.rank_error()
        assert got["none", p].quantile is None and got["none", p].n == 0
    whole = {r.column_name: r for r in sketches.quartile_cutoffs(sketches.merged(stored)).collect()}
    assert whole["w"].q2 == 2.0 and abs(whole["v"].q1 - 15_000) < 60_000 * 3 * sketches.rank_error()
