"""Registered queries that fit a model.

They return what the operators give: predicted prices, errors, parameters, importances. Fits are beyond SQL, so these
queries have no statement; the tests hold them against reference fits. Flags beside the values say what must hold for any fit.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from paddock.functions.stats import one_row
from paddock.models import benchmark, frame, linear, tfidf, trees, tuning
from paddock.operators.features import ColumnRoles, feature_frame
from paddock.operators.gold import TARGET
from paddock.plans import fixtures as fx
from paddock.plans.queries import KEY, Query, gold_table, pick, rounded, silver_table, split_sides
from paddock.session import compiled_methods, cut_lineage

PREP_COLUMNS = ("Mileage_km", "Year of construction", "owners_known", "price_in_eur")
ONEHOT_COLUMNS = ("Series", "Transmission", "Drive", "Car location", "Interior color")


def prepared(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, ColumnRoles]:
    """Training rows, test rows and columns; the frame is written once for the query."""
    table, roles = feature_frame(gold_table(spark, d))
    with compiled_methods(spark):
        table = cut_lineage(table)
    return (*frame.holdout(table), roles)


def predictions(predict: Callable[[DataFrame], DataFrame], train: DataFrame, test: DataFrame) -> DataFrame:
    """Test rows with actual and predicted price, whether the prediction is usable, and whether the model fits.

    ``usable``: a positive finite number whose residual is actual minus predicted. ``fits_training``: over the
    training rows the model's squared log error is below that of the best constant.
    """
    error = F.ln("predicted_price_eur") - F.ln(TARGET)
    fit = one_row(predict(train), model=F.sqrt(F.avg(error * error)), constant=F.stddev_pop(F.ln(TARGET)))
    scored = benchmark.as_predictions(predict(test))
    p = F.col("predicted_price_eur")
    usable = p.isNotNull() & ~F.isnan(p) & (p > 0) & (p < float("inf"))
    usable = usable & (F.abs(F.col("actual_price_eur") - p - F.col("residual_eur")) < 1e-6)
    return scored.select(
        "row_index",
        *[F.round(c, 2).alias(c) for c in ("actual_price_eur", "predicted_price_eur", "residual_eur")],
        F.coalesce(usable, F.lit(False)).cast("int").alias("usable"),
        F.coalesce(fit["model"] < fit["constant"], F.lit(False)).cast("int").alias("fits_training"),
    )


def median_baseline(spark, d):
    train, test = (split_sides(silver_table(spark, d)).where(f"is_test = {i} and price_in_eur is not null") for i in (0, 1))
    return rounded(pick(frame.median_baseline(train, test), *KEY, "predicted_price_eur"))


def numeric_prep(spark, d):
    table = frame.numeric_prep(silver_table(spark, d), PREP_COLUMNS)
    return rounded(pick(table, *KEY, *[f"{c}_scaled" for c in PREP_COLUMNS]))


def onehot(spark, d):
    return frame.onehot_counts(silver_table(spark, d), ONEHOT_COLUMNS)


def tfidf_weights(spark, d):
    return rounded(tfidf.tfidf_weights(fx.documents(spark, d), "doc_id", "text"))


def log_target_guard(spark, d):
    return frame.log_target_guard(fx.predictions(spark, d), "actual_price_eur")


def geo_mean_blend(spark, d):
    wide = (
        fx.predictions(spark, d)
        .groupBy("listing_key")
        .agg(
            F.max(F.when(F.col("model_name") == "ridge", F.col("predicted_price_eur"))).alias("a"),
            F.max(F.when(F.col("model_name") == "catboost", F.col("predicted_price_eur"))).alias("b"),
        )
    )
    # some predictions missing or below the floor
    wide = wide.withColumn("a", F.when(F.col("listing_key") % 59 == 0, F.lit(float("nan"))).otherwise(F.col("a")))
    return rounded(pick(linear.geo_mean_blend(wide, "a", "b", "blend"), "listing_key", "blend"), 3)


def ridge_predictions(spark, d):
    train, test, roles = prepared(spark, d)
    return predictions(linear.fit_ridge(train, roles, min_df=3).predict, train, test)


def elasticnet_predictions(spark, d):
    train, test, roles = prepared(spark, d)
    return predictions(linear.fit_elastic_net(train, roles, min_df=3).predict, train, test)


def auto_ridge_predictions(spark, d):
    train, test, roles = prepared(spark, d)
    return predictions(linear.fit_auto_ridge(train, roles).predict, train, test)


def specialist_predictions(spark, d):
    train, test, roles = prepared(spark, d)
    return predictions(linear.fit_specialist(train, roles).predict, train, test)


def stacked_predictions(spark, d):
    train, test, roles = prepared(spark, d)
    model = linear.fit_stacked(train, roles, min_df=3)
    meta = [F.lit(round(v, 6)).alias(name) for v, name in zip(model.meta, ("meta_ridge", "meta_net", "meta_intercept"))]
    return predictions(model.predict, train, test).select("*", *meta)


def gbt_predictions(spark, d):
    train, test, roles = prepared(spark, d)
    return predictions(trees.fit_boosted(train, roles).predict, train, test)


def gbt_earlystop_predictions(spark, d):
    train, test, roles = prepared(spark, d)
    return predictions(trees.fit_early_stopped(train, roles).predict, train, test)


def cat_gbt_predictions(spark, d):
    train, test, roles = prepared(spark, d)
    return predictions(trees.fit_category_boosted(train, roles).predict, train, test)


def quantile_interval(spark, d):
    train, test, roles = prepared(spark, d)
    interval = trees.quantile_interval(train, test, roles)
    low, mid, high = (F.col(c) for c in ("pred_lower", "pred_price", "pred_upper"))
    ordered = (low > 0) & (low <= mid) & (mid <= high) & (low < high) & (high < float("inf"))
    prices = [F.round(c, 2).alias(c) for c in (TARGET, "pred_lower", "pred_price", "pred_upper")]
    return interval.select("URL", *prices, F.coalesce(ordered, F.lit(False)).cast("int").alias("ordered"))


def tuned_elasticnet(spark, d):
    """All trials by rising error on held-out rows."""
    train, _, roles = prepared(spark, d)
    trials = tuning.tune_elastic_net(train, roles, min_df=3)
    rows = [(place, t["alpha"], t["l1_ratio"], round(t["mae_eur"], 2)) for place, t in enumerate(trials, 1)]
    return spark.createDataFrame(rows, "place int, alpha double, l1_ratio double, mae_eur double")


def cv_ridge(spark, d):
    train, _, roles = prepared(spark, d)
    rows = [(r["alpha"], round(r["rmse_mean"], 6), round(r["rmse_std"], 6), r["is_best"]) for r in tuning.cv_ridge(train, roles)]
    return spark.createDataFrame(rows, "alpha double, rmse_mean double, rmse_std double, is_best int")


def cv_elasticnet(spark, d):
    """40 penalties by 9 ratios over 5 folds."""
    train, _, roles = prepared(spark, d)
    rows = [(r["alpha"], r["l1_ratio"], round(r["mse_mean"], 8), round(r["mse_std"], 8), r["is_best"]) for r in tuning.cv_elastic_net(train, roles)]
    return spark.createDataFrame(rows, "alpha double, l1_ratio double, mse_mean double, mse_std double, is_best int")


def feature_importance(spark, d):
    """Every column given to the trees with its share of all gains."""
    train, _, roles = prepared(spark, d)
    return rounded(trees.feature_importance(trees.fit_boosted(train, roles)))


def model_queries() -> dict[str, Query]:
    named = (
        median_baseline, numeric_prep, onehot, tfidf_weights, log_target_guard, geo_mean_blend,
        ridge_predictions, elasticnet_predictions, auto_ridge_predictions, specialist_predictions,
        stacked_predictions, gbt_predictions, gbt_earlystop_predictions, cat_gbt_predictions,
        quantile_interval, tuned_elasticnet, cv_ridge, cv_elasticnet, feature_importance,
    )
    return {q.__name__: q for q in named}
