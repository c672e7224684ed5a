from __future__ import annotations

import pytest

from catalog import learning, outputs, streams
from catalog.registry import Registry
from pacewise.operators import models


class Fitted(Exception):
    pass


@pytest.mark.parametrize("query", [
    "_bookings", "_risk", "_rate", "_importances",
    "_bookings_summary", "_risk_summary", "_rate_summary", "_importance_summary",
])
def test_registered_fits_grow_the_published_number_of_trees(query, spark, monkeypatch):
    table = spark.range(4)
    rows = (table, table, ["x"])
    monkeypatch.setattr(learning, "_risk_frames", lambda *_: rows)
    monkeypatch.setattr(learning, "train", lambda *_: table)
    monkeypatch.setattr(learning, "gld_daily", lambda *_: table)
    monkeypatch.setattr(learning, "cut", lambda df: df)
    monkeypatch.setattr(learning.conformed, "training_set", lambda df: df)
    for split in ("row_fraction_split", "date_fraction_split"):
        monkeypatch.setattr(
            learning.split, split, lambda df: df.selectExpr("*", "'train' AS split")
        )
    monkeypatch.setattr(models, "usable_rows", lambda df, _: df)
    monkeypatch.setattr(models, "positive_weight", lambda *_: 1.0)

    def fit(df, features, target, trees=models.TREES, *_):
        raise Fitted(trees)

    for name in ("fit_regressor", "fit_classifier", "fit_calibrated"):
        monkeypatch.setattr(models, name, fit)
    with pytest.raises(Fitted) as found:
        getattr(learning, query)(spark, "unused")
    assert found.value.args == (400,)


def test_bronze_queries_build_no_other_layer(spark, monkeypatch):
    def refused(*_):
        raise AssertionError("a later layer is built")

    for plan in (outputs.conformed_plan, outputs.rolled_plan):
        monkeypatch.setattr(plan, "build_silver", refused)
    registry = Registry()
    outputs.plans(registry)
    folder = "/root/testdata/sf0.001/"  # no other test's runs
    for name in ("p03_bronze_performance", "p04_bronze_conversions"):
        assert registry.builds[name](spark, folder).count() > 0


def test_stream_exports_derive_their_raw_rows_once(spark, monkeypatch):
    derived, folder = [], "/root/testdata/sf0.001/."
    raw = dict(streams.star.RAW)
    counted = {t: lambda s, d, t=t: derived.append(t) or raw[t](s, d) for t in raw}
    monkeypatch.setattr(streams.star, "RAW", counted)
    rows = [streams._exports(spark, folder, t) for t in streams.I.CLEANERS for _ in (1, 2)]
    assert sorted(derived) == sorted(streams.I.CLEANERS)
    assert all(first.count() > 0 and second.count() > 0 for first, second in rows)
