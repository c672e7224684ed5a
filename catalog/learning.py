"""Queries for splits, folds, evaluation, and model fits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import star
from catalog.layers import gld_daily, train
from catalog.registry import Registry
from pacewise.functions.measures import flag
from pacewise.operators import conformed, evaluate, models, report, split
from pacewise.plans.rolled import RATE_TARGET, RISK_LABEL
from pacewise.session import cut
from pacewise.sources import schemas as S

TREES = models.TREES
ROW_KEY = ["order_key", "line_number", "ad_set_id", "date"]


def gold(spark: SparkSession, d: str) -> DataFrame:
    return star.sales_gold(spark, d).select(*ROW_KEY, "spend", "revenue", "pacing_status")


def scored(spark: SparkSession, d: str) -> DataFrame:
    """Labelled documents with their length as the score."""
    labels, documents = star.table(spark, d, "labels"), star.table(spark, d, "documents")
    return labels.join(documents, "doc_id").select(
        "doc_id", F.col("quality").alias("label"), F.col("n_chars").cast("double").alias("score")
    )


def add_to(r: Registry) -> None:
    splits(r)
    evaluation(r)
    fits(r)


def splits(r: Registry) -> None:
    hashed = "md5(concat_ws('|', order_key, line_number, ad_set_id, date))"
    r.add(
        "t05_row_split",
        lambda s, d: split.row_fraction_split(gold(s, d).select(*ROW_KEY), tie_break=ROW_KEY),
        f"""SELECT order_key, line_number, ad_set_id, date,
                   CASE WHEN row_number() OVER (ORDER BY date, {hashed}) <= floor(n * 0.8::DOUBLE)
                        THEN 'train' ELSE 'test' END AS split
            FROM gold CROSS JOIN (SELECT count(*) AS n FROM gold)""",
    )
    cutoff = """SELECT list_sort(list(DISTINCT date))
                       [greatest(1, floor(count(DISTINCT date) * 0.8::DOUBLE)::INT)] FROM gold"""
    r.add(
        "t06_date_split",
        lambda s, d: split.date_fraction_split(gold(s, d).select(*ROW_KEY)),
        f"""SELECT order_key, line_number, ad_set_id, date,
                   CASE WHEN date <= ({cutoff}) THEN 'train' ELSE 'valid' END AS split
            FROM gold""",
    )
    r.add(
        "m17_window_dates",
        lambda s, d: split.window_dates(split.date_fraction_split(gold(s, d))),
        f"""SELECT CASE WHEN date <= ({cutoff}) THEN 'train' ELSE 'valid' END AS split,
                   min(date) AS start, max(date) AS "end", count(*) AS row_count
            FROM gold GROUP BY 1""",
    )
    r.add(
        "m03_stratified_folds",
        lambda s, d: split.stratified_folds(
            gold(s, d).select(*ROW_KEY, "pacing_status"), "pacing_status", 5, ROW_KEY
        ),
        f"""SELECT order_key, line_number, ad_set_id, date, pacing_status,
                   CAST((row_number() OVER (PARTITION BY pacing_status ORDER BY {hashed}) - 1) % 5
                        AS INTEGER) AS fold FROM gold""",
    )
    bins = """least(greatest(CAST(spend >= q[1] AS INT) + CAST(spend >= q[2] AS INT)
                 + CAST(spend >= q[3] AS INT) + CAST(spend >= q[4] AS INT)
                 + CAST(spend >= q[5] AS INT), 1), 4)"""
    binned = f"""SELECT order_key, line_number, ad_set_id, date, spend,
                        CAST({bins} AS INTEGER) AS bin
                 FROM gold CROSS JOIN (SELECT quantile_cont(spend, [0, 0.25, 0.5, 0.75, 1]) AS q
                                       FROM gold)"""
    r.add(
        "x07_target_bins",
        lambda s, d: split.target_bins(gold(s, d).select(*ROW_KEY, "spend"), "spend"),
        binned,
    )
    r.add(
        "m04_target_folds",
        lambda s, d: split.target_folds(gold(s, d).select(*ROW_KEY, "spend"), "spend", 5, ROW_KEY),
        f"""SELECT *, CAST((row_number() OVER (PARTITION BY bin ORDER BY {hashed}) - 1) % 5
                      AS INTEGER) AS fold FROM ({binned})""",
    )


def evaluation(r: Registry) -> None:
    r.add(
        "m09_regression_metrics",
        lambda s, d: evaluate.regression_metrics(
            star.table(s, d, "lineitem"), "l_extendedprice", "l_quantity"
        ),
        """SELECT avg(abs(y - p)) AS mae, 1 - sum((y - p) ** 2) / (var_pop(y) * count(y)) AS r2
           FROM (SELECT l_extendedprice AS y, l_quantity AS p FROM lineitem)""",
        {"mae": 4, "r2": 6},
    )
    r.add(
        "m10_classification_metrics",
        lambda s, d: evaluate.classification_metrics(scored(s, d), "label", "score", 1000.0),
        """SELECT *, (tp + tn) / (tp + tn + fp + fn)::DOUBLE AS accuracy,
                  2 * tp / (2 * tp + fp + fn)::DOUBLE AS f1
           FROM (SELECT count(*) FILTER (label = 1 AND score >= 1000) AS tp,
                        count(*) FILTER (label = 0 AND score >= 1000) AS fp,
                        count(*) FILTER (label = 1 AND score < 1000) AS fn,
                        count(*) FILTER (label = 0 AND score < 1000) AS tn FROM scored)""",
        {"accuracy": 6, "f1": 6},
    )
    auc = """(sum(mean_rank) FILTER ({y} = 1) - p * (p + 1) / 2.0::DOUBLE) / (p * q)"""
    ranked = """SELECT *, (2 * rank() OVER (ORDER BY score) + count(*) OVER (PARTITION BY score) - 1)
                       / 2.0::DOUBLE AS mean_rank FROM {t}"""
    r.add(
        "m11_auc",
        lambda s, d: evaluate.roc_auc(scored(s, d), "label", "score"),
        f"""SELECT {auc.format(y="label")} AS auc FROM ({ranked.format(t="scored")})
            CROSS JOIN (SELECT sum(label)::DOUBLE AS p, sum(1 - label)::DOUBLE AS q FROM scored)
            GROUP BY p, q""",
        {"auc": 9},
    )
    r.add(
        "m11_auc_order_lines",
        lambda s, d: evaluate.roc_auc(
            gold(s, d).withColumn("label", flag(F.col("pacing_status") == "under_pacing")),
            "label",
            "spend",
        ),
        f"""SELECT {auc.format(y="label")} AS auc
            FROM ({ranked.format(t='''(SELECT *, spend AS score,
                 CAST(pacing_status = 'under_pacing' AS INT) AS label FROM gold)''')})
            CROSS JOIN (SELECT count(*) FILTER (pacing_status = 'under_pacing')::DOUBLE AS p,
                        count(*) FILTER (pacing_status <> 'under_pacing')::DOUBLE AS q FROM gold)
            GROUP BY p, q""",
        {"auc": 9},
    )
    steps = """SELECT score, sum(label) AS pos, sum(1 - label) AS neg FROM scored GROUP BY score"""
    curve = f"""SELECT score, pos, neg, sum(pos) OVER w AS cp, sum(neg) OVER w AS cn,
                       lead(pos) OVER w AS np, lead(neg) OVER w AS nn,
                       row_number() OVER w AS i,
                       sum(pos) OVER () AS p, sum(neg) OVER () AS n
                FROM ({steps}) WINDOW w AS (ORDER BY score DESC)"""
    for name, kept in [
        ("m12_roc_points", "i = 1 OR np IS NULL OR np <> pos OR nn <> neg"),
        ("m12_roc_all_points", "TRUE"),
    ]:
        r.add(
            name,
            lambda s, d, thin=(kept != "TRUE"): evaluate.roc_points(
                scored(s, d), "label", "score", drop_intermediate=thin
            ),
            f"""SELECT 0::DOUBLE AS fpr, 0::DOUBLE AS tpr, 'infinity'::DOUBLE AS threshold
                UNION ALL SELECT cn / n::DOUBLE, cp / p::DOUBLE, score FROM ({curve}) WHERE {kept}""",
            {"fpr": 9, "tpr": 9},
        )
    flipped = """SELECT doc_id, score,
                        CASE WHEN row_number() OVER (ORDER BY md5(doc_id::VARCHAR))
                                  <= floor(n * 0.1::DOUBLE) THEN 1 - label ELSE label END AS label
                 FROM scored CROSS JOIN (SELECT count(*) AS n FROM scored)"""
    r.add(
        "m13_flipped_labels",
        lambda s, d: evaluate.flip_labels(scored(s, d), "label", 0.1, ["doc_id"]),
        flipped,
    )

    def auc_of(table: str) -> str:
        return f"""SELECT {auc.format(y="label")} AS auc FROM ({ranked.format(t=f"({table})")})
                   CROSS JOIN (SELECT sum(label)::DOUBLE AS p, sum(1 - label)::DOUBLE AS q
                               FROM ({table})) GROUP BY p, q"""

    r.add(
        "m13_noise_robustness",
        lambda s, d: evaluate.noise_robustness(scored(s, d), "label", "score", 0.1, ["doc_id"]),
        f"""SELECT ({auc_of("SELECT * FROM scored")}) AS auc_base,
                   ({auc_of(flipped)}) AS auc_noisy""",
        {"auc_base": 9, "auc_noisy": 9},
    )
    r.add(
        "f23_usable_rows",
        lambda s, d: models.usable_rows(
            star.table(s, d, "lineitem").select(
                "l_orderkey",
                "l_linenumber",
                F.when(F.col("l_linenumber") == 1, F.lit(float("inf")))
                .otherwise(F.col("l_quantity"))
                .alias("quantity"),
                F.when(F.col("l_returnflag") == "R", F.lit(float("-inf")))
                .otherwise(F.col("l_tax"))
                .alias("target"),
            ),
            "target",
        ),
        """SELECT l_orderkey, l_linenumber,
                  CASE WHEN l_linenumber <> 1 THEN l_quantity END AS quantity, l_tax AS target
           FROM lineitem WHERE l_returnflag <> 'R'""",
    )
    r.add(
        "f24_complete_rows",
        lambda s, d: models.complete_rows(
            gld_daily(s, d).select(*S.KEYS, "roas", "cpa"), ["roas", "cpa"]
        ).select(*S.KEYS),
        "SELECT date, ad_set_id FROM gld_daily WHERE roas IS NOT NULL AND cpa IS NOT NULL",
    )


def _risk_frames(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, list[str]]:
    """Every row, the training part of the usable rows, and the features."""
    table = cut(train(spark, d))
    wanted = models.with_optional(S.NEXT_DAY_RISK_FEATURES, table, ["revenue"])
    features = models.checked_features(wanted)
    parts = split.date_fraction_split(models.usable_rows(table, RISK_LABEL))
    return table, parts.filter(F.col("split") == split.TRAIN), features


def _bookings(spark: SparkSession, d: str) -> DataFrame:
    table = cut(conformed.training_set(gld_daily(spark, d)))
    parts = split.row_fraction_split(table)
    model = models.fit_regressor(
        parts.filter(F.col("split") == split.TRAIN), S.BOOKINGS_FEATURES, "target_bookings", TREES
    )
    return models.predict(model, parts, S.BOOKINGS_FEATURES, "predicted").select(
        *S.KEYS, "split", "target_bookings", "predicted"
    )


def _risk(spark: SparkSession, d: str) -> DataFrame:
    table, training, features = _risk_frames(spark, d)
    weight = models.positive_weight(training, RISK_LABEL)
    model = models.fit_calibrated(training, features, RISK_LABEL, TREES, weight)
    return models.score_keys(model.transform(table, "under_pacing_risk"), "under_pacing_risk")


def _rate(spark: SparkSession, d: str) -> DataFrame:
    table = cut(train(spark, d))
    features = models.checked_features(S.NEXT_DAY_RISK_FEATURES)
    parts = split.date_fraction_split(models.usable_rows(table, RATE_TARGET))
    model = models.fit_regressor(
        parts.filter(F.col("split") == split.TRAIN), features, RATE_TARGET, TREES
    )
    return models.score_keys(models.predict(model, table, features, "conv_prob"), "conv_prob")


def _importances(spark: SparkSession, d: str) -> DataFrame:
    _, training, features = _risk_frames(spark, d)
    weight = models.positive_weight(training, RISK_LABEL)
    model = models.fit_classifier(training, features, RISK_LABEL, TREES, weight)
    return report.importance_ranking(models.importances(model, features, spark))


def _bookings_summary(spark: SparkSession, d: str) -> DataFrame:
    scored = cut(_bookings(spark, d))
    fitted = scored.filter(F.col("split") == split.TRAIN)
    r2 = evaluate.regression_metrics(fitted, "target_bookings", "predicted").select("r2").scalar()
    return scored.agg(
        F.count(F.lit(1)).alias("rows_scored"),
        F.count_if(F.col("predicted").isNull() | F.isnan("predicted")).alias("without_score"),
    ).withColumn("better_than_mean", r2 > 0)


def _risk_summary(spark: SparkSession, d: str) -> DataFrame:
    table, training, features = _risk_frames(spark, d)
    weight = models.positive_weight(training, RISK_LABEL)
    model = models.fit_calibrated(training, features, RISK_LABEL, TREES, weight)
    scored = cut(model.transform(table, "risk").select(RISK_LABEL, "risk"))
    auc = evaluate.roc_auc(scored, RISK_LABEL, "risk").select("auc").scalar()
    inside = F.coalesce(F.col("risk").between(0, 1), F.lit(False))
    return scored.agg(
        F.count(F.lit(1)).alias("rows_scored"), F.count_if(~inside).alias("outside")
    ).withColumn("better_than_chance", auc > 0.5)


def _rate_summary(spark: SparkSession, d: str) -> DataFrame:
    return _rate(spark, d).agg(
        F.count(F.lit(1)).alias("rows_scored"),
        F.count_if(F.col(S.AD_SET).isNull()).alias("without_ad_set"),
        F.count_if(F.col("conv_prob").isNull() | F.isnan("conv_prob")).alias("without_score"),
    )


def _importance_summary(spark: SparkSession, d: str) -> DataFrame:
    return _importances(spark, d).agg(
        F.count(F.lit(1)).alias("features"), F.sum("importance_pct").alias("total_pct")
    )


def _weights(spark: SparkSession, d: str) -> DataFrame:
    """neg / pos of all rows, and of rows of one class only, where it is 1."""
    table = cut(train(spark, d))
    out = []
    for what, rows in (("all", table), ("positives", table.filter(F.col(RISK_LABEL) == 1))):
        weight = models.positive_weight(rows, RISK_LABEL)
        n = rows.agg(F.count(F.lit(1)).alias("n"))
        out.append(n.select(F.lit(what).alias("what"), "n", F.lit(float(weight)).alias("weight")))
    return out[0].union(out[1])


def fits(r: Registry) -> None:
    """Scores differ in digits from other libraries' trees; what must hold of them is compared."""
    r.add(
        "m01_m02_fit_summary",
        _bookings_summary,
        """SELECT count(*) AS rows_scored, count(*) FILTER (false) AS without_score,
                  true AS better_than_mean FROM gld_training""",
    )
    r.add(
        "m05_m07_m08_fit_summary",
        _risk_summary,
        """SELECT count(*) AS rows_scored, count(*) FILTER (false) AS outside,
                  true AS better_than_chance FROM train""",
    )
    r.add(
        "m02_m08_score_summary",
        _rate_summary,
        """SELECT count(*) AS rows_scored, count(*) FILTER (ad_set_id IS NULL) AS without_ad_set,
                  count(*) FILTER (false) AS without_score FROM train""",
    )
    r.add(
        "m14_importance_summary",
        _importance_summary,
        """SELECT 7::BIGINT AS features, 100.0::DOUBLE AS total_pct
           FROM (SELECT count(*) AS n FROM train) WHERE n > 0""",
        {"total_pct": 6},
    )
    r.add(
        "m06_positive_weight",
        _weights,
        """SELECT 'all' AS what, count(*) AS n,
                  count(*) FILTER (label_under_pacing_next = 0)::DOUBLE
                  / count(*) FILTER (label_under_pacing_next = 1) AS weight FROM train
           UNION ALL
           SELECT 'positives', count(*), 1.0 FROM train WHERE label_under_pacing_next = 1""",
        {"weight": 6},
    )
    r.add("m01_m02_bookings_predictions", _bookings)
    r.add("m05_m06_m07_m08_under_pacing_risk", _risk)
    r.add("m02_m08_conversion_rate_scores", _rate)
    r.add("m14_t04_importance_ranking", _importances)
