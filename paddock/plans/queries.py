"""The registered queries: every operator on the tables of one scale-factor folder."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from paddock.functions.numeric import sanitize_nonfinite
from paddock.functions.stats import hash_bucket
from paddock.models import cards
from paddock.operators import (
    collinearity,
    combine,
    dashboard,
    evaluation,
    features,
    gold,
    hygiene,
    legacy,
    quality,
    registry,
    rules,
    silver,
    upsert,
)
from paddock.plans import fixtures as fx
from paddock.session import cut_lineage, work_folder
from paddock.sources import pages, rates, sections, tables

Query = Callable[[SparkSession, str], DataFrame]

KEY = ["ingest_order", "URL"]
REFRESHED = ("Description", "Secondary_Description")
AS_OF = "2001-08-01 12:00:00"
AS_OF_YEAR = 2026
EXACT = ("Mileage_sq", "Mileage_model_cat", "Mileage_sq_model_cat")


def raw(spark: SparkSession, d: str) -> DataFrame:
    return fx.listings_raw(spark, d)


def silver_table(spark: SparkSession, d: str) -> DataFrame:
    return silver.bronze_to_silver(raw(spark, d), fx.fx_rates(spark), fx.SHOP_PREFIX)


def gold_table(spark: SparkSession, d: str) -> DataFrame:
    return gold.silver_to_gold(silver_table(spark, d))


def stamp(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss")


def rounded(df: DataFrame, digits: int = 6, exact: Sequence[str] = (), **other: int) -> DataFrame:
    """Doubles rounded for comparison: ``digits`` places, or those named per column.

    ``exact`` columns are products and differences of inputs, alike to the last bit.
    """
    columns = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DoubleType) and f.name not in exact:
            c = F.round(c, other.get(f.name, digits)).alias(f.name)
        columns.append(c)
    return df.select(*columns)


def pick(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*[F.col(f"`{c}`") for c in columns])


# ---- sources and sinks ---------------------------------------------------------


def src_read_formats(spark, d):
    schema = T.StructType(
        [
            T.StructField("ingest_order", T.LongType()),
            T.StructField("URL", T.StringType()),
            T.StructField("Price", T.StringType()),
            T.StructField("Description", T.StringType()),
        ]
    )
    listings = pick(raw(spark, d), *schema.fieldNames())
    both = tables.round_trip_counts(listings, work_folder(spark, "formats"), schema)
    return both.groupBy("format").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum("ingest_order").alias("key_sum"),
        F.count("Price").alias("n_prices"),
        F.sum(F.length("Description")).alias("n_chars"),
    )


def latest_snapshot(spark, d):
    stamped = raw(spark, d).withColumn("run_ts", F.date_format("Scraped_At", "yyyyMMdd"))
    return pick(tables.latest_snapshot(stamped), *KEY, "Title", "run_ts")


def fx_rate_table(spark, d):
    cached = (
        silver.parse_price(raw(spark, d))
        .where("currency is not null and Scraped_At is not null")
        .groupBy("currency", F.col("Scraped_At").alias("fetched_at"))
        .agg((F.avg("price") / 100000).alias("units"))
    )
    return rounded(rates.rate_table(cached, AS_OF))


def pages_extract(spark, d):
    found = pages.extract_listings(fx.table(spark, d, "pages"))
    return found.select(
        "page_id",
        "Title",
        F.size("links").cast("bigint").alias("n_links"),
        F.size("paragraphs").cast("bigint").alias("n_paragraphs"),
        F.size("items").cast("bigint").alias("n_items"),
    )


def pages_sections(spark, d):
    """Paragraphs of the article, items of the navigation and the footer, as counts and digests of their texts."""
    found = sections.page_elements(fx.table(spark, d, "pages"), "html", "elements", "texts")
    elements, texts = F.col("elements"), F.col("texts")

    def items(nav):
        return F.transform(F.filter(elements, lambda e: (e["tag"] == "li") & sections.inside(e, nav)), lambda e: sections.text_of(e, texts))

    def first(tag):
        return sections.first_below(elements, (tag, None, None))

    read = found.withColumns({"article": first("article"), "nav": first("nav"), "footer": first("footer")}).select(
        "page_id",
        sections.paragraphs_of(elements, texts, F.col("article")).alias("paragraphs"),
        items(F.col("nav")).alias("items"),
        sections.text_of(F.col("footer"), texts).alias("footer"),
    )
    return read.select(
        "page_id",
        F.size("paragraphs").cast("bigint").alias("n_paragraphs"),
        F.md5(F.array_join("paragraphs", "\n")).alias("paragraphs_md5"),
        F.size("items").cast("bigint").alias("n_items"),
        F.md5(F.array_join("items", "\n")).alias("items_md5"),
        F.md5("footer").alias("footer_md5"),
    )


def new_listing_keys(spark, d):
    return upsert.new_listing_keys(fx.listings_next(spark, d), fx.listings_prev(spark, d))


def row_hash(spark, d):
    return pick(upsert.row_hash(raw(spark, d)), *KEY, "Data_Hash")


def field_changes(spark, d):
    return upsert.field_changes(fx.listings_prev(spark, d), fx.listings_next(spark, d))


def upsert_listings(spark, d):
    result = upsert.upsert_listings(fx.listings_prev(spark, d), fx.listings_next(spark, d))
    return result.withColumn("Scraped_At", stamp("Scraped_At"))


def upsert_typed(spark, d):
    """The crawl written into a table that stores years as numbers."""
    year = "Year of construction"
    stored = fx.listings_prev(spark, d).withColumn(year, upsert.fitted(F.col(f"`{year}`"), T.IntegerType()))
    result = upsert.upsert_listings(stored, fx.listings_next(spark, d))
    uncast = F.element_at("uncast_values", year).alias("uncast_year")
    return result.select(*KEY, F.col(f"`{year}`"), uncast, "Data_Hash", "action")


def typed_overwrite(spark, d):
    target = T.StructType(
        [
            T.StructField("Year of construction", T.IntegerType()),
            T.StructField("Number of vehicle owners", T.DoubleType()),
        ]
    )
    typed = upsert.typed_overwrite(fx.listings_next(spark, d), target)
    return typed.select(
        *KEY,
        F.col("Year of construction"),
        F.col("Number of vehicle owners"),
        F.try_element_at("uncast_values", F.lit("Year of construction")).alias("uncast_year"),
        F.size("uncast_values").alias("n_uncast"),
    )


def change_log(spark, d):
    return upsert.change_log(fx.listings_prev(spark, d), fx.listings_next(spark, d), AS_OF)


def keep_last_by_key(spark, d):
    both = upsert.append_keep_last(fx.listings_prev(spark, d), fx.listings_next(spark, d))
    return pick(both, *KEY, "Title", "Price", "Error", "Extra")


def refresh_descriptions(spark, d):
    stored = fx.listings_prev(spark, d)
    return pick(upsert.refresh_columns(stored, fx.listings_next(spark, d), REFRESHED), *KEY, "Description")


def sanitize(spark, d):
    p = F.col("predicted_price_eur")
    a = F.col("actual_price_eur")
    ratio = F.when(a == 0, F.lit(float("inf"))).otherwise(F.try_divide(p, a))
    odd = F.when(F.col("o_orderstatus") == "P", F.lit(float("nan"))).otherwise(ratio)
    return rounded(
        sanitize_nonfinite(
            fx.predictions(spark, d).select("listing_key", "model_name", ratio.alias("ratio"), odd.alias("odd_ratio"))
        )
    )


def card_model_pick(spark, d):
    metrics = evaluation.regression_metrics(fx.predictions(spark, d), by=["model_name"])
    return rounded(cards.card_model_pick(metrics).select("model_name", "mae_eur"), 4)


# ---- bronze to silver ------------------------------------------------------------


def parse_price(spark, d):
    return pick(silver.parse_price(raw(spark, d)), *KEY, "price", "currency")


def parse_price_legacy(spark, d):
    return pick(legacy.parse_price_legacy(raw(spark, d)), *KEY, "legacy_price", "legacy_currency")


def dedupe_url(spark, d):
    return pick(silver.dedupe_url(raw(spark, d)), *KEY, "Title", "Price")


def drop_shop_links(spark, d):
    return pick(silver.drop_shop_links(raw(spark, d), fx.SHOP_PREFIX), *KEY)


def mileage_extract(spark, d):
    return pick(silver.mileage_extract(raw(spark, d)), *KEY, "mileage_value", "mileage_unit")


def mileage_impute(spark, d):
    return pick(silver.mileage_impute(silver.mileage_extract(raw(spark, d))), *KEY, "mileage_value")


def mileage_km(spark, d):
    return rounded(pick(silver.clean_mileage(raw(spark, d)), *KEY, "mileage_unit", "Mileage_km"))


def clean_condition(spark, d):
    return pick(
        silver.clean_condition(raw(spark, d)),
        *KEY, "Condition", "Paint-to-Sample (PTS)", "Matching numbers", "Number of vehicle owners",
    )


def derived_flags(spark, d):
    cleaned = silver.derived_flags(silver.clean_condition(raw(spark, d)))
    return pick(cleaned, *KEY, "owners_known", "is_fully_restored")


def standardize_series(spark, d):
    return pick(silver.standardize_series(raw(spark, d)), *KEY, "Series")


def price_in_eur(spark, d):
    priced = silver.price_in_eur(silver.parse_price(raw(spark, d)), fx.fx_rates(spark))
    return rounded(pick(priced, *KEY, "price_in_eur", "currency_known"))


def silver_listings(spark, d):
    return rounded(silver_table(spark, d).withColumn("Scraped_At", stamp("Scraped_At")))


def legacy_filters(spark, d):
    return rounded(pick(legacy.legacy_filters(silver_table(spark, d)), *KEY, "Mileage_km", "price_in_eur"))


def legacy_usage(spark, d):
    used = legacy.legacy_usage(silver_table(spark, d), AS_OF_YEAR)
    return rounded(pick(used, *KEY, "age", "mileage_rounded", "mileage_per_year"))


def legacy_ready_to_drive(spark, d):
    used = legacy.legacy_usage(silver_table(spark, d), AS_OF_YEAR)
    return pick(legacy.legacy_ready_to_drive(used), *KEY, "age", "Ready to drive")


def dq_report(spark, d):
    return rounded(quality.dq_report(raw(spark, d), silver_table(spark, d)), 4)


def dq_thresholds(spark, d):
    flagged = quality.dq_thresholds(silver_table(spark, d))
    return flagged.select(*KEY, F.array_join("violations", ",").alias("violations"))


# ---- silver to gold --------------------------------------------------------------


def gold_listings(spark, d):
    table = gold_table(spark, d).withColumn("Scraped_At", stamp("Scraped_At"))
    return rounded(table, exact=EXACT, inv_mileage=9, inv_Mileage_model_cat=9)


def outliers_linear(spark, d):
    return rounded(pick(gold.remove_outliers(silver_table(spark, d), "price_in_eur", 1.5), *KEY, "price_in_eur"))


def outliers_log(spark, d):
    kept = gold.remove_outliers(silver_table(spark, d), "price_in_eur", 1.5, use_log=True)
    return rounded(pick(kept, *KEY, "price_in_eur"))


def log_features(spark, d):
    return rounded(pick(gold.log_features(silver_table(spark, d)), *KEY, "log_price", "log_mileage", "Mileage_sq"), exact=EXACT)


def price_inflation(spark, d):
    return rounded(pick(gold.price_inflation(raw(spark, d)), *KEY, "price_inflation_factor"))


def model_category(spark, d):
    return pick(gold.model_category(raw(spark, d)), *KEY, "Model", "model_category")


def model_interactions(spark, d):
    table = gold.model_interactions(gold.model_category(silver_table(spark, d)))
    return rounded(
        pick(table, *KEY, "model_cat_ordered", "inv_mileage", "Mileage_model_cat", "inv_Mileage_model_cat", "Mileage_sq_model_cat"),
        exact=EXACT, inv_mileage=9, inv_Mileage_model_cat=9,
    )


def model_category_legacy(spark, d):
    return pick(legacy.model_category_legacy(raw(spark, d)), *KEY, "legacy_category", "legacy_cat_ordered")


def listing_text(spark, d):
    return pick(gold.with_listing_text(raw(spark, d)), *KEY, "listing_text")


def text_flags(spark, d):
    return pick(gold.text_flags(gold.with_listing_text(raw(spark, d))), *KEY, *rules.TEXT_FLAGS)


def text_flags_legacy(spark, d):
    flagged = legacy.text_flags_legacy(raw(spark, d))
    return rounded(pick(flagged, *KEY, *[f"legacy_{f}" for f in rules.LEGACY_TEXT_FLAGS], "legacy_score"))


def score_components(spark, d):
    scored = gold.score_components(silver_table(spark, d))
    return pick(scored, *KEY, *[c for c in scored.columns if c.startswith("points_")])


def listing_score(spark, d):
    return rounded(pick(gold.listing_score(silver_table(spark, d)), *KEY, "listing_score"))


def score_penalty(spark, d):
    flagged = gold.text_flags(gold.with_listing_text(raw(spark, d)))
    return rounded(flagged.select(*KEY, gold.penalty().alias("penalty")))


def binary_flags(spark, d):
    return pick(gold.binary_flags(raw(spark, d)), *KEY, "state_yes", "state_Rear drive", "matching_yes")


def prepare_features(spark, d):
    ready = gold.prepare_features(silver_table(spark, d))
    return rounded(pick(ready, *KEY, "Year of construction", "Interior color", "Exterior color", "price_in_eur"))


# ---- combining -------------------------------------------------------------------


def padded(df: DataFrame) -> DataFrame:
    """Keys with stray blanks, and a blank key now and then."""
    k = F.col("ingest_order")
    return df.withColumn(
        "URL", F.when(k % 101 == 0, F.lit("  ")).otherwise(F.concat(F.lit(" "), F.col("URL"), F.lit("\t")))
    )


def normalize_keys(spark, d):
    return pick(combine.normalize_keys(padded(raw(spark, d))), *KEY)


def row_completeness(spark, d):
    return pick(combine.row_completeness(silver_table(spark, d)), *KEY, "completeness_score")


def union_gold(spark, d):
    both = combine.union_gold(fx.listings_prev(spark, d), fx.listings_next(spark, d))
    return both.groupBy("source_order").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count("Extra").alias("n_extra"),
        F.count("Error").alias("n_error"),
        F.sum(F.length("Description")).alias("n_chars"),
        F.sum("ingest_order").alias("key_sum"),
    )


def combine_gold(spark, d):
    both = combine.combine_gold(fx.listings_prev(spark, d), padded(fx.listings_next(spark, d)))
    return pick(both, *KEY, "Title", "Price", "Error", "Extra")


def predictions_long(spark, d):
    all_models = fx.predictions(spark, d)
    frames = {
        name: all_models.where(F.col("model_name") == name).drop("model_name") for name in fx.PREDICTION_MODELS
    }
    table = evaluation.residuals(combine.predictions_long(frames))
    return pick(table, "listing_key", "model_name", "actual_price_eur", "predicted_price_eur", "residual_eur")


# ---- feature selection -----------------------------------------------------------

DUMMY_COLUMNS = ("Series", "Transmission", "Car location", "Interior color")
VIF_NUMERIC = ("Mileage_km", "Year of construction", "owners_known", "is_fully_restored", "Paint-to-Sample (PTS)")
VIF_CATEGORICAL = ("Series", "Transmission")
CORR_COLUMNS = (
    "price_in_eur", "log_price", "Mileage_km", "log_mileage", "Mileage_sq", "listing_score", "Year of construction",
)


def select_columns(spark, d):
    return pick(features.column_usage(gold_table(spark, d)), "feature", "role", "n_filled")


def feature_frame(spark, d):
    frame, roles = features.feature_frame(gold_table(spark, d))
    chosen = [c for c in roles.features if c not in roles.text]
    return rounded(
        pick(frame, "URL", *chosen, "price_in_eur"),
        exact=EXACT, inv_mileage=9, inv_Mileage_model_cat=9,
    )


def feature_screen(spark, d):
    screened = quality.feature_screen(silver_table(spark, d))
    return screened.withColumn("reasons", F.array_join("reasons", ","))


def linear_columns(spark, d):
    return pick(features.column_usage(gold_table(spark, d)).where("role <> 'text'"), "feature", "used_by_linear", "n_filled")


def split_sides(df: DataFrame, seed: int = 42, buckets: int = 4) -> DataFrame:
    """``is_test`` 1 for one bucket of the key hash."""
    return df.withColumn("is_test", (hash_bucket(F.col("URL"), seed, buckets) == 0).cast("int"))


def aligned_dummies(spark, d):
    sides = split_sides(silver_table(spark, d))
    _, test = features.aligned_dummies(
        sides.where("is_test = 0"), sides.where("is_test = 1"), DUMMY_COLUMNS, ("Year of construction", "price_in_eur")
    )
    return rounded(test)


def vif_design(spark, d):
    return collinearity.design_matrix(silver_table(spark, d), VIF_NUMERIC, VIF_CATEGORICAL)


def vif_gram(spark, d):
    sums = collinearity.gram(vif_design(spark, d))
    return rounded(sums.withColumn("value", F.col("value") / 1000000), 2)


def vif(spark, d):
    return rounded(collinearity.vif(vif_design(spark, d)), 4)


def corr_matrix(spark, d):
    table = gold.listing_score(gold.log_features(silver_table(spark, d)))
    return rounded(collinearity.corr_matrix(table, CORR_COLUMNS))


# ---- evaluation ------------------------------------------------------------------


def regression_metrics(spark, d):
    return rounded(evaluation.regression_metrics(fx.predictions(spark, d), by=["model_name"]), 4)


def segment_metrics(spark, d):
    return rounded(evaluation.segment_metrics(fx.predictions(spark, d), ["o_orderstatus", "o_orderpriority", "region"]), 4)


def residuals(spark, d):
    return pick(evaluation.residuals(fx.predictions(spark, d)), "listing_key", "model_name", "residual_eur")


def rmse_r2(spark, d):
    sides = fx.predictions(spark, d).withColumn("is_test", (hash_bucket(F.col("listing_key"), 42, 4) == 0).cast("int"))
    scored = evaluation.rmse_r2(sides, ["model_name"])
    return rounded(scored.join(evaluation.overfit_gap(sides, "is_test", ["model_name"]), "model_name"), 4)


def interval_coverage(spark, d):
    return rounded(evaluation.interval_coverage(fx.predictions(spark, d), ["model_name"]))


def residual_summary(spark, d):
    return rounded(evaluation.residual_summary(evaluation.residuals(fx.predictions(spark, d)), ["model_name"]), 4)


def watchlist(spark, d):
    return rounded(
        pick(
            evaluation.watchlist(fx.predictions(spark, d)),
            "listing_key", "model_name", "label", "rank", "residual_eur", "price_delta_pct",
        ),
        exact=["residual_eur"],
    )


def details(spark, d):
    return raw(spark, d).select(F.col("ingest_order").alias("listing_key"), "Title", "Series", F.col("Car location"))


def bargains(spark, d):
    cheap = evaluation.bargains(fx.predictions(spark, d), details(spark, d), "listing_key")
    return pick(cheap, "listing_key", "model_name", "actual_price_eur", "pred_lower", "Title", "Series", "Car location")


def residual_outliers(spark, d):
    far = evaluation.residual_outliers(fx.predictions(spark, d), details(spark, d), "listing_key")
    return pick(far, "listing_key", "model_name", "residual_eur", "Title", "Series", "Car location")


def monthly_error(df: DataFrame) -> DataFrame:
    """Mean absolute error per order month; months are few."""
    month = F.date_format("o_orderdate", "yyyy-MM").alias("month")
    return df.groupBy(month).agg(F.round(F.avg(F.abs(F.col("actual_price_eur") - F.col("predicted_price_eur"))), 4).alias("mae"))


def bootstrap_ci(spark, d):
    samples = tables.add_position(monthly_error(fx.predictions(spark, d)), "month")
    return rounded(evaluation.bootstrap_mean_ci(samples, "mae", "position"), 3)


def bootstrap_ci_rows(spark, d):
    error = F.abs(F.col("actual_price_eur") - F.col("predicted_price_eur"))
    errors = fx.predictions(spark, d).select("listing_key", "model_name", error.alias("error"))
    return rounded(evaluation.bootstrap_mean_ci_rows(errors, "error", ["listing_key"], ["model_name"]), 3)


def paired_ablation(spark, d):
    k = F.col("listing_key")
    error = F.abs(F.col("actual_price_eur") - F.col("predicted_price_eur"))
    scores = (
        fx.predictions(spark, d)
        .where("model_name <> 'catboost'")
        .groupBy((hash_bucket(k, 7, 5) + 42).alias("seed"), (F.col("model_name") == "ridge").alias("use_feature"))
        .agg(F.round(F.avg(error), 4).alias("mae"))
    )
    return rounded(evaluation.paired_ablation(scores), 3)


def category_stats(spark, d):
    table = gold.listing_score(gold.model_category(gold.drop_missing_target(silver_table(spark, d))))
    return evaluation.category_stats(table)


def market_summary(spark, d):
    table = gold.model_category(gold.drop_missing_target(silver_table(spark, d)))
    return rounded(evaluation.market_summary(table), 4)


def model_comparison(spark, d):
    """Each run's metrics as the JSON report holds them, read back and ranked."""
    fields = [F.col(c).alias(c) for c in ("mae_eur", "mape")]
    entry = F.struct("model_name", F.struct(*fields).alias("m"))
    reports = metrics_stored(spark, d).groupBy("run_id").agg(
        F.to_json(F.map_from_entries(F.array_sort(F.collect_list(entry)))).alias("metrics")
    )
    return rounded(pick(evaluation.model_comparison(reports), "run_id", "model_name", "mae_eur", "mape", "rank", "is_best"))


def outlier_count(spark, d):
    return rounded(gold.outlier_count(silver_table(spark, d), n_std=1.5))


def histogram(spark, d):
    scored = gold.listing_score(gold.drop_missing_target(silver_table(spark, d)))
    # texts are scored once; bounds and counts read the narrow copy
    table = cut_lineage(pick(scored, "price_in_eur", "Mileage_km", "listing_score", "Model", "Year of construction"))
    counts = evaluation.histogram(table, {"price_in_eur": 50, "Mileage_km": 50, "listing_score": 30})
    top = evaluation.top_values(table, "Model", 10).select(
        F.concat(F.lit("top Model "), F.col("value")).alias("column"), F.lit(None).cast("bigint").alias("bin"), "n",
        F.lit(None).cast("double").alias("bin_start"),
    )
    years = (
        table.groupBy(F.concat(F.lit("year "), F.col("Year of construction")).alias("column"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select("column", F.lit(None).cast("bigint").alias("bin"), "n", F.lit(None).cast("double").alias("bin_start"))
    )
    return rounded(counts.unionByName(top).unionByName(years), 4)


def leaderboard(spark, d):
    return rounded(evaluation.leaderboard(fx.predictions(spark, d)), 4)


def sigma_interval(spark, d):
    return rounded(
        pick(
            evaluation.sigma_interval(fx.predictions(spark, d)),
            "listing_key", "model_name", "pred_lower", "pred_upper",
        ),
        3,
    )


# ---- registry --------------------------------------------------------------------


def metrics_stored(spark, d):
    return registry.unique_rows(fx.model_metrics(spark, d))


def skips_stored(spark, d):
    return registry.unique_rows(fx.skipped_models(spark, d))


def registry_append(spark, d):
    offered = fx.model_metrics(spark, d)
    stored = registry.append_unique(
        registry.unique_rows(offered.where("mae_eur < 20")).withColumn("insert_order", F.lit(0).cast("bigint")),
        offered.where("mae_eur >= 10"),
    )
    return rounded(stored.drop("insert_order").withColumn("next_run_id", registry.next_run_id(fx.runs(spark, d))))


def latest_run(spark, d):
    last = registry.latest_run(fx.runs(spark, d), metrics_stored(spark, d), skips_stored(spark, d))
    entries = F.transform(
        F.map_entries("metrics"),
        lambda e: F.concat_ws("=", e["key"], F.round(e["value"]["mae_eur"], 0).cast("bigint").cast("string")),
    )
    return rounded(
        last.select(
            "id", "created_at", "output_dir", "duration_sec",
            F.coalesce(F.array_join(entries, ","), F.lit("")).alias("metrics"),
            F.coalesce(F.array_join(F.map_keys("skipped"), ","), F.lit("")).alias("skipped"),
        )
    )


def run_history(spark, d):
    return rounded(registry.run_history(fx.runs(spark, d), metrics_stored(spark, d)).drop("output_dir"))


def best_summary(spark, d):
    return registry.best_run_summary(fx.runs(spark, d), metrics_stored(spark, d), skips_stored(spark, d))


def best_run_summary(spark, d):
    return rounded(best_summary(spark, d))


def best_run_skips(spark, d):
    runs = skips_stored(spark, d).select("run_id").unionByName(best_summary(spark, d).select("run_id"))
    listed = registry.best_run_skips(runs, skips_stored(spark, d))
    pairs = F.transform("skipped_models", lambda s: F.concat_ws(":", s["model_name"], s["reason"]))
    return listed.select("run_id", F.array_join(pairs, ",").alias("skipped_models"))


def run_fallback(spark, d):
    runs = fx.runs(spark, d)
    readable = runs.where("output_dir is not null and git_commit <> '5-LOW'").select(
        "output_dir", F.col("created_at").alias("modified_at")
    )
    return registry.run_fallback(runs, readable)


# ---- dashboard and hygiene -------------------------------------------------------


def dash(spark, d):
    return dashboard.dash_frame(silver_table(spark, d))


def dash_frame(spark, d):
    return rounded(pick(dash(spark, d).withColumn("scraped", stamp("scraped")), *KEY, "scraped", "year", "km"))


def dash_facets(spark, d):
    return dashboard.dash_facets(dash(spark, d))


def filtered(spark, d):
    return dashboard.dash_filter(
        dash(spark, d),
        {"Transmission": ["Manual"], "Series": ["982", "987", "981"]},
        {"price_in_eur": (20000, 400000), "km": (0, 200000), "year": (1970, 2020)},
        "Carrera",
    )


def dash_filter(spark, d):
    return pick(filtered(spark, d), *KEY, "Title")


def dash_table(spark, d):
    return rounded(
        dashboard.dash_table(
            dash(spark, d), ["Title", "Model", "year", "km", "price_in_eur", "URL"], "ingest_order"
        )
    )


def price_timeline(spark, d):
    return rounded(dashboard.price_timeline(dash(spark, d)).withColumn("scraped", stamp("scraped")))


def model_summary(spark, d):
    return rounded(dashboard.model_summary(silver_table(spark, d)), 4)


def row_at_offset(spark, d):
    return pick(dashboard.row_at_offset(dash(spark, d), 100, "ingest_order"), *KEY, "Title", "price_text")


def path_leak_scan(spark, d):
    """Documents as they are, with one path style per source written into the text."""
    styles = ("C:\\Users\\ann\\x", "D:\\data\\AppData\\Local\\Temp", "\\\\NAS_home/share", "/users/ann", "/home/ann/x")
    k = F.col("doc_id")
    style = F.element_at(F.array(*map(F.lit, styles)), (k % len(styles) + 1).cast("int"))
    documents = fx.documents(spark, d).select(
        "doc_id", F.when(k % 25 < 5, F.concat_ws(" ", "text", style)).otherwise(F.col("text")).alias("text")
    )
    return hygiene.path_leak_scan(documents, "doc_id", "text")


def holdout_split(spark, d):
    return pick(split_sides(silver_table(spark, d)), *KEY, "is_test")


def plain_queries() -> dict[str, Query]:
    """Queries without a fitted model."""
    named: Sequence[Query] = (
        src_read_formats, latest_snapshot, fx_rate_table, pages_extract, pages_sections, new_listing_keys, row_hash,
        field_changes, upsert_listings, upsert_typed, typed_overwrite, change_log, keep_last_by_key,
        refresh_descriptions, card_model_pick, parse_price, parse_price_legacy, dedupe_url,
        drop_shop_links, mileage_extract, mileage_impute, mileage_km, clean_condition, derived_flags,
        standardize_series, price_in_eur, silver_listings, legacy_filters, legacy_usage,
        legacy_ready_to_drive, dq_report, dq_thresholds, gold_listings, outliers_linear, outliers_log,
        log_features, price_inflation, model_category, model_interactions, model_category_legacy,
        listing_text, text_flags, text_flags_legacy, score_components, listing_score, score_penalty,
        binary_flags, prepare_features, normalize_keys, row_completeness, union_gold, combine_gold,
        predictions_long, select_columns, feature_frame, feature_screen, linear_columns,
        aligned_dummies, vif_gram, vif, corr_matrix, regression_metrics, segment_metrics, residuals,
        rmse_r2, interval_coverage, residual_summary, watchlist, bargains, residual_outliers,
        bootstrap_ci, bootstrap_ci_rows, paired_ablation, category_stats, market_summary, model_comparison,
        outlier_count, histogram, leaderboard, sigma_interval, registry_append, latest_run,
        run_history, best_run_summary, best_run_skips, run_fallback, dash_frame, dash_facets,
        dash_filter, dash_table, price_timeline, model_summary, row_at_offset, path_leak_scan,
        holdout_split,
    )
    return {q.__name__: q for q in named} | {"sanitize_nonfinite": sanitize}
