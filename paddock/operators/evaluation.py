"""Error metrics, intervals, watchlists and summary statistics."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

from paddock.functions.digests import md5_of_keys
from paddock.functions.ranking import first_n_per_key
from paddock.functions.stats import exact_quantiles, join_groups, one_row

ACTUAL, PREDICTED = "actual_price_eur", "predicted_price_eur"
# Error bands, interval width, outlier reach, bargain limit.
BANDS = {"within_10pct": 0.10, "within_15pct": 0.15}
INTERVAL_Z = 1.645
OUTLIER_STD = 1.5
BARGAIN_LIMIT = 90000
OVERFIT_GAP = 0.1


def _require_rows(df: DataFrame) -> None:
    if df.isEmpty():
        raise ValueError("y_true and y_pred must not be empty")


def _errors(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    a, p = F.col(actual), F.col(predicted)
    error = F.abs(a - p)
    relative = (
        F.when(a != 0, F.try_divide(error, F.abs(a)))
        .when(error == 0, F.lit(0.0))
        .otherwise(F.lit(float("inf")))
    )
    return df.withColumns({"__abs": error, "__pct": relative})


def regression_metrics(
    df: DataFrame,
    actual: str = ACTUAL,
    predicted: str = PREDICTED,
    by: Sequence[str] = (),
    check: bool = False,
) -> DataFrame:
    """MAE, median absolute error, MAPE and the shares within 10 and 15 percent.

    An actual of 0 counts as no relative error if met exactly, else as infinite.
    ``check`` raises on empty input.
    """
    if check:
        _require_rows(df)
    errors = _errors(df, actual, predicted)
    simple = errors.groupBy(*[F.col(f"`{c}`") for c in by]).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.avg("__abs").alias("mae_eur"),
        F.avg("__pct").alias("mape"),
        *[F.avg((F.col("__pct") <= limit).cast("double")).alias(name) for name, limit in BANDS.items()],
    )
    medians = exact_quantiles(errors, F.col("__abs"), {"median_ae_eur": 0.5}, by)
    return join_groups(simple, medians, by)


def segment_metrics(
    df: DataFrame, segments: Sequence[str], actual: str = ACTUAL, predicted: str = PREDICTED
) -> DataFrame:
    """The metrics per value of every segment column at hand; missing values are left out."""
    present = [c for c in segments if c in df.columns]
    long = (
        df.select(actual, predicted, *[F.col(f"`{c}`").cast("string").alias(c) for c in present])
        .unpivot([actual, predicted], present, "segment_column", "segment_value")
        .where(F.col("segment_value").isNotNull())
    )
    return regression_metrics(long, actual, predicted, ["segment_column", "segment_value"])


def residuals(df: DataFrame, actual: str = ACTUAL, predicted: str = PREDICTED) -> DataFrame:
    return df.withColumn("residual_eur", F.col(actual) - F.col(predicted))


def _r2(a: Column, p: Column) -> Column:
    return F.lit(1.0) - F.try_divide(F.sum(F.pow(a - p, F.lit(2.0))), F.var_pop(a) * F.count(a))


def rmse_r2(df: DataFrame, by: Sequence[str], actual: str = ACTUAL, predicted: str = PREDICTED) -> DataFrame:
    """RMSE, MAE and R² in EUR and on the log scale (values below 1 count as 1 there)."""
    a, p = F.col(actual), F.col(predicted)
    la, lp = F.ln(F.greatest(a, F.lit(1.0))), F.ln(F.greatest(p, F.lit(1.0)))
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("sample_size"),
        F.sqrt(F.avg(F.pow(a - p, F.lit(2.0)))).alias("rmse_eur"),
        F.avg(F.abs(a - p)).alias("mae_eur"),
        _r2(a, p).alias("r2"),
        F.sqrt(F.avg(F.pow(la - lp, F.lit(2.0)))).alias("rmse_log"),
        F.avg(F.abs(la - lp)).alias("mae_log"),
        _r2(la, lp).alias("r2_log"),
    )


def overfit_gap(df: DataFrame, split: str, by: Sequence[str], actual: str = ACTUAL, predicted: str = PREDICTED) -> DataFrame:
    """R² of the training rows minus that of the test rows (``split`` 0 and 1), and a flag beyond 0.1."""
    scored = rmse_r2(df, [*by, split], actual, predicted)

    def of(part: int) -> Column:
        return F.max(F.when(F.col(split) == part, F.col("r2")))

    return (
        scored.groupBy(*by)
        .agg(of(0).alias("r2_train"), of(1).alias("r2_test"))
        .withColumn("r2_gap", F.col("r2_train") - F.col("r2_test"))
        .withColumn("overfit", (F.col("r2_gap") > OVERFIT_GAP).cast("int"))
    )


def interval_coverage(df: DataFrame, by: Sequence[str], actual: str = ACTUAL) -> DataFrame:
    inside = F.col(actual).between(F.col("pred_lower"), F.col("pred_upper"))
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"), F.avg(inside.cast("double")).alias("interval_coverage")
    )


def residual_summary(df: DataFrame, by: Sequence[str], residual: str = "residual_eur") -> DataFrame:
    r = F.col(residual)
    simple = df.groupBy(*by).agg(
        F.count(r).alias("n_rows"),
        F.avg(r).alias("mean"),
        F.stddev_samp(r).alias("std"),
        F.min(r).alias("min"),
        F.max(r).alias("max"),
    )
    return join_groups(simple, exact_quantiles(df, r, {"median": 0.5}, by), by)


def watchlist(df: DataFrame, n: int = 10, key: str = "listing_key", actual: str = ACTUAL, predicted: str = PREDICTED) -> DataFrame:
    """The ``n`` furthest listings below and above their interval, with the relative gap."""
    r = residuals(df, actual, predicted)
    label = F.when(F.col(actual) < F.col("pred_lower"), F.lit("Underpriced")).when(
        F.col(actual) > F.col("pred_upper"), F.lit("Overpriced")
    )
    outside = r.withColumn("label", label).where(F.col("label").isNotNull())
    reach = F.when(F.col("label") == "Underpriced", F.col("residual_eur")).otherwise(-F.col("residual_eur"))
    return first_n_per_key(outside, ["label"], [reach, F.col(key), F.col("model_name")], n).withColumn(
        "price_delta_pct", F.try_divide(F.col("residual_eur"), F.col(predicted))
    )


def bargains(df: DataFrame, listings: DataFrame, key: str, limit: float = BARGAIN_LIMIT) -> DataFrame:
    """Listings priced below both prediction and lower bound and below ``limit``, with their details."""
    cheap = df.where(
        (F.col(ACTUAL) < F.col(PREDICTED)) & (F.col(ACTUAL) < F.col("pred_lower")) & (F.col(ACTUAL) < limit)
    )
    return cheap.join(listings, key)


def residual_outliers(
    df: DataFrame, listings: DataFrame, key: str, n_std: float = OUTLIER_STD, by: Sequence[str] = ("model_name",)
) -> DataFrame:
    """Listings whose residual exceeds ``n_std`` population deviations of its group (one model), with their details."""
    r = residuals(df)
    spread = r.groupBy(*by).agg(F.stddev_pop("residual_eur").alias("__std"))
    far = join_groups(r, spread, by).where(F.abs("residual_eur") > F.lit(n_std) * F.col("__std")).drop("__std")
    return far.join(listings, key)


def sigma_interval(
    df: DataFrame, actual: str = ACTUAL, predicted: str = PREDICTED, z: float = INTERVAL_Z, by: Sequence[str] = ("model_name",)
) -> DataFrame:
    """Interval of ``z`` sample deviations of the group's (one model's) log residual around the log prediction."""
    log_p = F.ln(F.col(predicted))
    spread = df.where(F.col(actual) > 0).groupBy(*by).agg(F.stddev_samp(F.ln(F.col(actual)) - log_p).alias("__std"))
    reach = F.lit(z) * F.col("__std")
    return join_groups(df, spread, by).withColumns({"pred_lower": F.exp(log_p - reach), "pred_upper": F.exp(log_p + reach)}).drop("__std")


def bootstrap_mean_ci(
    samples: DataFrame, value: str, position: str, iterations: int = 2000, seed: int = 42, alpha: float = 0.05
) -> DataFrame:
    """Percentile interval of the mean over resamples with replacement.

    ``position`` numbers the samples 0..n-1. Every sample row stands for one draw
    per resample: the draw picks a position by hash, equal picks are counted
    before they meet their value, and no resample is ever held in one place.
    """
    _require_rows(samples)
    n = one_row(samples, n=F.count(F.lit(1)))["n"]
    pick = F.conv(
        F.substring(
            F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("b").cast("string"), F.col(position).cast("string"))), 1, 8
        ),
        16,
        10,
    ).cast("bigint")
    draws = (
        samples.select(F.col(position), F.explode(F.sequence(F.lit(0), F.lit(iterations - 1))).alias("b"))
        .select("b", (pick % n).alias("__pick"))
        .groupBy("b", "__pick")
        .agg(F.count(F.lit(1)).alias("times"))
    )
    picked = samples.select(F.col(position).cast("bigint").alias("__pick"), F.col(value).alias("__value"))
    means = (
        draws.join(picked, "__pick")
        .groupBy("b")
        .agg((F.sum(F.col("__value") * F.col("times")) / F.sum("times")).alias("mean"))
    )
    return exact_quantiles(means, F.col("mean"), {"ci_low": alpha / 2, "ci_high": 1 - alpha / 2})


# Shares of a Poisson(1) weight of at most 0, 1, ... as 32-bit numbers, like 8 hex digits of a hash; beyond 12 the share is one.
POISSON_LIMITS = [math.floor(2**32 * p) for p in accumulate(math.exp(-1) / math.factorial(k) for k in range(13))]
PER_DIGEST = 4
KEYS_AT_ONCE, GROUPS_AT_ONCE = 16_384, 500


def resample_sums(iterations: int, seed: int, schema: T.StructType) -> Callable:
    """Sums of all resamples over a task's keys, per group: the group's columns, and for each resample the weighted sum and the weighted count.

    A key's weight in four resamples is of mean and variance one, from the 32 hex digits of a digest. At most ``GROUPS_AT_ONCE`` groups and
    ``KEYS_AT_ONCE`` keys, or one batch, are held. The function travels whole: executors may not have this package.
    """
    digests, limits, per, most_keys, most_groups = md5_of_keys(), list(POISSON_LIMITS), PER_DIGEST, KEYS_AT_ONCE, GROUPS_AT_ONCE
    prefixes = [f"{seed}|{d}|".encode() for d in range(-(-iterations // per))]
    unsure = 255

    def numbered(columns, n: int):
        """For each row the number of its group, and a row of each group."""
        import numpy as np
        import pyarrow as pa

        found = np.zeros(n, np.int64)
        for column in columns:
            try:
                coded = column.dictionary_encode(null_encoding="encode")
            except pa.ArrowNotImplementedError:  # nested
                coded = pa.array([repr(x) for x in column.to_pylist()]).dictionary_encode()
            found = np.unique(found * (len(coded.dictionary) + 1) + coded.indices.to_numpy(), return_inverse=True)[1]
        _, first, number = np.unique(found, return_index=True, return_inverse=True)
        return number, first

    def run(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(schema)
        width = len(target) - 2
        # the weight by the first 16 of the 32 bits, as they lie in memory, where these decide
        sixteen = np.arange(1 << 16, dtype=np.uint32)
        lowest = ((sixteen & 255) << 24) | ((sixteen >> 8) << 16)
        edges = np.array(limits, np.uint32)
        table = np.searchsorted(edges, lowest, "right").astype(np.uint8)
        table[table != np.searchsorted(edges, lowest | 0xFFFF, "right")] = unsure

        def weights(words, out):
            for row, word in zip(out, words):
                found = table[word.view("<u2")[::2]]
                doubt = np.flatnonzero(found == unsure)
                if len(doubt):
                    found[doubt] = np.searchsorted(edges, word[doubt].byteswap(), "right")
                row[:] = found

        held: dict[str, int] = {}
        named, sums = [], []

        def emitted():
            arrays = [pa.concat_arrays([n[i] for n in named]).cast(target.field(i).type) for i in range(width)]
            both = np.stack(sums)[:, :iterations]
            arrays += [pa.array(list(np.ascontiguousarray(both[:, :, i])), target.field(width + i).type) for i in (0, 1)]
            return pa.RecordBatch.from_arrays(arrays, schema=target)

        def add(part):
            texts, own = part.column(0).to_pylist(), part.column(1)
            rows = np.repeat(np.arange(len(own)), np.diff(own.offsets.to_numpy()))
            fields = own.flatten().flatten()
            v, n = fields[-2].to_numpy(), fields[-1].to_numpy().astype(float)
            number, first = numbered(fields[:-2], len(v))
            for low in range(0, len(first), most_groups):
                here = np.flatnonzero((number >= low) & (number < low + most_groups))
                used, at = np.unique(rows[here], return_inverse=True)
                found = summed([texts[k] for k in used], at, number[here] - low, v[here], n[here])
                for row, group_sums in zip(first[low : low + most_groups], found):
                    group = [f.slice(row, 1) for f in fields[:-2]]
                    name = repr([x[0].as_py() for x in group])
                    if name not in held:
                        held[name] = len(named)
                        named.append(group)
                        sums.append(group_sums)
                    else:
                        sums[held[name]] = sums[held[name]] + group_sums
                if len(named) >= most_groups:
                    yield emitted()
                    held.clear(), named.clear(), sums.clear()

        def summed(texts, rows, number, v, n):
            """Sums of all resamples by group, of values ``v`` and counts ``n`` that the keys numbered ``rows`` have in the groups ``number``."""
            groups = int(number.max()) + 1
            dense = groups * len(texts) <= 8 * len(v)  # else a key stands in few of the groups
            if dense:
                values = np.zeros((len(texts), 2 * groups))
                np.add.at(values, (rows, 2 * number), v)
                np.add.at(values, (rows, 2 * number + 1), n)
            found = np.zeros((groups, len(prefixes) * per, 2))
            data, ends = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([len(x) for x in texts])
            for d, keys, words in digests(data, ends, prefixes):
                weight = np.empty((per, len(keys)))
                weights(words, weight)
                if dense:
                    found[:, d * per : (d + 1) * per] += (weight @ values[keys]).reshape(per, groups, 2).swapaxes(0, 1)
                    continue
                place = np.full(len(texts), -1)
                place[keys] = np.arange(len(keys))
                here = np.flatnonzero(place[rows] >= 0)
                for i in range(per):
                    w = weight[i][place[rows[here]]]
                    found[:, d * per + i, 0] += np.bincount(number[here], w * v[here], groups)
                    found[:, d * per + i, 1] += np.bincount(number[here], w * n[here], groups)
            return found

        def flush():
            for part in pa.Table.from_batches(waiting).combine_chunks().to_batches():
                yield from add(part)

        waiting, count = [], 0
        for batch in batches:
            if len(batch):
                waiting.append(batch)
                count += len(batch)
            if count >= most_keys:
                yield from flush()
                waiting, count = [], 0
        if waiting:
            yield from flush()
        if named:
            yield emitted()

    return run


def bootstrap_mean_ci_rows(
    df: DataFrame, value: str, key: Sequence[str], by: Sequence[str] = (), iterations: int = 2000, seed: int = 42, alpha: float = 0.05
) -> DataFrame:
    """Mean and its percentile interval per group, for samples of any number of rows.

    In each resample a row counts as often as a Poisson(1) number from the hash of its ``key`` says, which is what
    drawing with replacement tends to as rows grow; few rows are better drawn by ``bootstrap_mean_ci``. Rows need no
    numbering: they are added up by key and group, then a task adds up all resamples of its keys, and one sum for each
    task, group and four resamples is shuffled, however many rows there are or a group has. ``key`` tells rows apart; rows of an equal
    key get equal weights. Rows without a finite value are left out, as are resamples in which no row counts.
    """
    _require_rows(df)
    by, v = list(by), F.col(f"`{value}`").cast("double")
    names = [F.col(f"`{c}`").alias(f"__g{i}") for i, c in enumerate(by)]
    text = F.concat_ws("|", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in key])
    rows = df.select(*names, v.alias("__v"), text.alias("__key")).where(v.isNotNull() & (F.abs(v) < float("inf")))
    groups = [f"__g{i}" for i in range(len(by))]
    # an equal key is digested once, for all its rows and groups; keys are spread over all tasks however few files or bytes hold them
    held = F.struct(*groups, F.col("__v"), F.col("__n"))
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = (
        rows.groupBy("__key", *groups).agg(F.sum("__v").alias("__v"), F.count(F.lit(1)).alias("__n"))
        .repartition(parts, "__key").groupBy("__key").agg(F.collect_list(held).alias("__held"))
    )
    names = rows.select(*groups).schema.fields
    added = T._parse_datatype_string("__s array<double>, __n array<double>")
    schema = T.StructType([*names, *added.fields])
    packed = keys.select(F.col("__key").cast("binary"), "__held").mapInArrow(resample_sums(iterations, seed, schema), schema)
    resamples = F.arrays_zip(F.sequence(F.lit(0), F.lit(iterations - 1)).alias("b"), F.col("__s").alias("s"), F.col("__n").alias("n"))
    each = packed.select(*groups, F.explode(resamples).alias("__r")).select(*groups, "__r.b", "__r.s", "__r.n")
    sums = each.groupBy(*groups, "b").agg(F.sum("s").alias("__s"), F.sum("n").alias("__n"))
    means = sums.select(*[F.col(g).alias(c) for g, c in zip(groups, by)], F.try_divide("__s", "__n").alias("mean"))
    bounds = exact_quantiles(means, F.col("mean"), {"ci_low": alpha / 2, "ci_high": 1 - alpha / 2}, by)
    finite = v.isNotNull() & (F.abs(v) < float("inf"))
    if not by:
        return df.where(finite).agg(F.avg(v).alias("mean")).select("mean", *[bounds.select(c).scalar().alias(c) for c in ("ci_low", "ci_high")])
    centre = df.where(finite).groupBy(*by).agg(F.avg(v).alias("mean"))
    return join_groups(centre, bounds, by)


def paired_ablation(scores: DataFrame, iterations: int = 2000, alpha: float = 0.05) -> DataFrame:
    """Error without minus error with a feature per ``seed``, its mean and interval.

    ``scores`` holds (seed, use_feature, mae); seeds are few.
    """
    pairs = scores.groupBy("seed").agg(
        F.max(F.when(F.col("use_feature"), F.col("mae"))).alias("with_feature_mae"),
        F.max(F.when(~F.col("use_feature"), F.col("mae"))).alias("without_feature_mae"),
    )
    deltas = pairs.withColumn("delta_mae", F.col("without_feature_mae") - F.col("with_feature_mae"))
    numbered = deltas.withColumn("position", F.row_number().over(Window.orderBy("seed")) - 1)
    interval = bootstrap_mean_ci(numbered, "delta_mae", "position", iterations, alpha=alpha)
    summary = one_row(deltas, mean=F.avg("delta_mae"))
    bounds = interval.select(F.struct("ci_low", "ci_high")).scalar()
    return deltas.select(
        "*",
        summary["mean"].alias("delta_mae_mean"),
        bounds["ci_low"].alias("ci_low"),
        bounds["ci_high"].alias("ci_high"),
    )


def category_stats(df: DataFrame, category: str = "model_category", price: str = "price_in_eur") -> DataFrame:
    simple = df.groupBy(category).agg(
        F.count(price).alias("n"),
        F.avg(price).alias("price_mean"),
        F.stddev_samp(price).alias("price_std"),
        F.avg("Mileage_km").alias("mileage_mean"),
        F.avg("listing_score").alias("score_mean"),
    )
    medians = exact_quantiles(df, F.col(price), {"price_median": 0.5}, [category])
    both = join_groups(simple, medians, [category])
    rounded = [F.round(c, 2).alias(c) for c in both.columns if c not in (category, "n")]
    return both.select(category, "n", *rounded).orderBy(F.col("n").desc(), category)


def market_summary(df: DataFrame, category: str = "model_category", price: str = "price_in_eur") -> DataFrame:
    """Describe with the 10, 50 and 90 percent quantiles: all rows, then per category."""
    p = F.col(price)
    stats = [
        F.count(p).alias("n"),
        F.avg(p).alias("mean"),
        F.stddev_samp(p).alias("std"),
        F.min(p).alias("min"),
        F.max(p).alias("max"),
    ]
    # each row once for its category and once for the whole
    long = df.select(p, F.explode(F.array(F.col(category), F.lit("(all)"))).alias("segment"))
    quantiles = exact_quantiles(long, p, {"p10": 0.1, "p50": 0.5, "p90": 0.9}, ["segment"])
    return join_groups(long.groupBy("segment").agg(*stats), quantiles, ["segment"])


def model_comparison(metrics_json: DataFrame) -> DataFrame:
    """Rows per model from a JSON object of metric objects, ranked by MAE; the best is marked."""
    parsed = F.from_json(
        "metrics", "map<string, struct<mae_eur: double, median_ae_eur: double, mape: double, within_10pct: double, within_15pct: double>>"
    )
    rows = metrics_json.select("run_id", F.explode(parsed).alias("model_name", "m")).select("run_id", "model_name", "m.*")
    order = Window.partitionBy("run_id").orderBy("mae_eur", "model_name")
    return rows.withColumn("rank", F.row_number().over(order)).withColumn("is_best", (F.col("rank") == 1).cast("int"))


def leaderboard(predictions: DataFrame) -> DataFrame:
    """Metrics per model, ranked by MAE. Models are few, so one task ranks them."""
    scored = regression_metrics(predictions, by=["model_name"])
    return scored.withColumn("rank", F.rank().over(Window.orderBy("mae_eur")))


def histogram(df: DataFrame, bins: dict[str, int]) -> DataFrame:
    """Equal-width counts between minimum and maximum for several columns at once."""
    names = list(bins)
    long = (
        df.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in names])
        .unpivot([], names, "column", "v")
        .where(F.col("v").isNotNull())
    )
    stats = one_row(df, **{f"{f}{i}": g(F.col(f"`{c}`").cast("double"))
                            for i, c in enumerate(names) for f, g in (("lo", F.min), ("hi", F.max))})
    long = long.withColumn("__ranges", stats)
    ranges = F.col("__ranges")
    bin_number, low, width = F.lit(None).cast("bigint"), F.lit(None).cast("double"), F.lit(None).cast("double")
    for i, c in enumerate(names):
        lo, hi, n = ranges[f"lo{i}"], ranges[f"hi{i}"], bins[c]
        step = (hi - lo) / n
        # the last bin holds the maximum
        place = F.least(F.floor(F.coalesce(F.try_divide(F.col("v") - lo, step), F.lit(0.0))), F.lit(n - 1))
        here = F.col("column") == c
        bin_number = F.when(here, place).otherwise(bin_number)
        low = F.when(here, lo).otherwise(low)
        width = F.when(here, step).otherwise(width)
    return (
        long.withColumns({"bin": bin_number, "__low": low, "__width": width})
        .groupBy("column", "bin")
        .agg(F.count(F.lit(1)).alias("n"), F.max(F.col("__low") + F.col("bin") * F.col("__width")).alias("bin_start"))
    )


def top_values(df: DataFrame, column: str, n: int) -> DataFrame:
    return (
        df.where(F.col(f"`{column}`").isNotNull())
        .groupBy(F.col(f"`{column}`").cast("string").alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.col("n").desc(), "value")
        .limit(n)
    )
