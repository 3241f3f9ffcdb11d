"""Keeping the Bronze table current: new keys, changes, replacement, refresh."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from paddock.functions.ranking import first_per_key
from paddock.functions.text import trimmed

# Fields that make up a listing's content, and prices that are none.
HASHED_FIELDS = ("Title", "Price", "Mileage", "Description", "Secondary_Description")
EMPTY_PRICES = ("reserved", "", "n/a")
_SEPARATOR = "\u001f"
UNCAST = "uncast_values"


def new_listing_keys(seen: DataFrame, known: DataFrame, key: str = "URL") -> DataFrame:
    """Keys seen now: ``new`` if not stored yet, else ``existing`` (to be re-checked)."""
    seen = seen.select(key).where(F.col(key).isNotNull()).distinct()
    known = known.select(key).where(F.col(key).isNotNull()).distinct().withColumn("__known", F.lit(True))
    return seen.join(known, key, "left").select(
        key, F.when(F.col("__known"), F.lit("existing")).otherwise(F.lit("new")).alias("status")
    )


def _field(df: DataFrame, name: str, side: str | None = None) -> Column:
    if name not in df.columns:
        return F.lit("")
    column = F.col(f"{side}.`{name}`") if side else F.col(f"`{name}`")
    return F.coalesce(column.cast("string"), F.lit(""))


def content_hash(df: DataFrame, fields: Sequence[str] = HASHED_FIELDS, side: str | None = None) -> Column:
    """MD5 over the fields in sorted name order; a missing field counts as empty."""
    return F.md5(F.concat_ws(_SEPARATOR, *[_field(df, f, side) for f in sorted(fields)]))


def row_hash(df: DataFrame, fields: Sequence[str] = HASHED_FIELDS) -> DataFrame:
    return df.withColumn("Data_Hash", content_hash(df, fields))


def change_text(old: DataFrame, new: DataFrame, fields: Sequence[str] = HASHED_FIELDS) -> Column:
    """``field: 'old' → 'new'`` per differing field, NULL when nothing differs (sides o and n)."""
    parts = []
    for f in fields:
        before, after = _field(old, f, "o"), _field(new, f, "n")
        parts.append(
            F.when(before != after, F.concat(F.lit(f"{f}: '"), before, F.lit("' → '"), after, F.lit("'")))
        )
    return F.nullif(F.concat_ws("; ", *parts), F.lit(""))


def keep_last_by_key(df: DataFrame, key: str = "URL", version: str = "ingest_order") -> DataFrame:
    """Latest version of every key."""
    return first_per_key(df, [key], [F.col(version).desc()])


def append_keep_last(old: DataFrame, new: DataFrame, key: str = "URL") -> DataFrame:
    """Old and new rows together, the new row winning per key."""
    both = old.withColumn("__batch", F.lit(0)).unionByName(
        new.withColumn("__batch", F.lit(1)), allowMissingColumns=True
    )
    return first_per_key(both, [key], [F.col("__batch").desc(), F.col("ingest_order").desc()]).drop("__batch")


def _paired(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Stored and scraped row side by side (o, n), with what to do about them.

    Both sides hold one row per key, so no key can blow up the join. The ranking
    has already partitioned both by key, so the join adds no shuffle.
    """
    o = keep_last_by_key(old, key).withColumn("__old", F.lit(True)).alias("o")
    n = keep_last_by_key(new.where(F.col(key).isNotNull()), key).withColumn("__new", F.lit(True)).alias("n")
    others = [f for f in HASHED_FIELDS if f != "Price"]
    same_rest = reduce(and_, [_field(old, f, "o") == _field(new, f, "n") for f in others])
    only_price = same_rest & (_field(old, "Price", "o") != _field(new, "Price", "n"))
    no_price = F.lower(trimmed(_field(new, "Price", "n"))).isin(*EMPTY_PRICES)
    old_hash = (
        F.coalesce(F.col("o.Data_Hash"), F.lit("")) if "Data_Hash" in old.columns else content_hash(old, side="o")
    )
    failed = _field(new, "Error", "n") != ""
    action = (
        F.when(F.col("__old").isNull(), F.lit("insert"))
        .when(F.col("__new").isNull(), F.lit("keep"))
        .when(failed, F.lit("keep"))
        .when(old_hash == content_hash(new, side="n"), F.lit("keep"))
        .when(only_price & no_price, F.lit("keep"))
        .otherwise(F.lit("replace"))
    )
    return o.join(n, F.col(f"o.{key}") == F.col(f"n.{key}"), "full").withColumn("__action", action)


def upsert_listings(
    old: DataFrame, new: DataFrame, key: str = "URL", fill_missing: bool = False
) -> DataFrame:
    """Stored table after a crawl, with the ``action`` taken per row.

    A replaced row is the scraped row as a whole: what the scrape lacks becomes
    NULL, or keeps the stored value with ``fill_missing``. Scraped values take the
    stored types; text that does not fit becomes NULL and is kept in the map
    ``uncast_values``, which is there if any type differs. Hashes and changes
    compare the scraped text.
    """
    pairs = _paired(old, new, key)
    kept = F.col("__action") == "keep"
    columns, failures = [], []
    for c in [*old.columns, *[c for c in new.columns if c not in old.columns]]:
        if c in ("Data_Hash", UNCAST):
            continue
        before = F.col(f"o.`{c}`") if c in old.columns else F.lit(None)
        after = F.col(f"n.`{c}`") if c in new.columns else F.lit(None)
        if c in old.columns and c in new.columns and old.schema[c].dataType != new.schema[c].dataType:
            scraped, after = after, fitted(after, old.schema[c].dataType)
            failures.append(_uncast(c, scraped, after))
        if fill_missing:
            after = F.when(F.col("__action") == "replace", F.coalesce(after, before)).otherwise(after)
        columns.append(F.when(kept, before).otherwise(after).alias(c))
    old_hash = F.col("o.Data_Hash") if "Data_Hash" in old.columns else content_hash(old, side="o")
    digest = F.when(kept, old_hash).otherwise(content_hash(new, side="n"))
    if failures or UNCAST in old.columns:
        empty = F.lit(None).cast("map<string,string>")
        before = F.col(f"o.`{UNCAST}`") if UNCAST in old.columns else empty
        after = F.map_from_entries(F.array_compact(F.array(*failures))) if failures else empty
        columns.append(F.when(kept, before).otherwise(after).alias(UNCAST))
    return pairs.select(*columns, digest.alias("Data_Hash"), F.col("__action").alias("action"))


def field_changes(old: DataFrame, new: DataFrame, key: str = "URL") -> DataFrame:
    """Change text for every key on both sides."""
    o = keep_last_by_key(old, key).alias("o")
    n = keep_last_by_key(new, key).alias("n")
    return o.join(n, F.col(f"o.{key}") == F.col(f"n.{key}")).select(
        F.col(f"o.{key}").alias(key), change_text(old, new).alias("changes")
    )


def change_log(old: DataFrame, new: DataFrame, as_of: str, key: str = "URL") -> DataFrame:
    """One line per replaced listing."""
    return (
        _paired(old, new, key)
        .where("__action = 'replace'")
        .select(
            F.col(f"n.{key}").alias(key),
            F.coalesce(change_text(old, new), F.lit("hash-only update")).alias("Changes"),
            F.lit(as_of).alias("Date"),
        )
    )


def fitted(column: Column, dtype: T.DataType) -> Column:
    """A value in another type, NULL where it does not fit."""
    if isinstance(dtype, T.IntegralType):
        return column.try_cast("double").try_cast(dtype)
    if isinstance(dtype, T.TimestampType):
        return F.try_to_timestamp(column.cast("string"))
    return column.try_cast(dtype)


def _uncast(name: str, scraped: Column, value: Column) -> Column:
    lost = scraped.isNotNull() & value.isNull()
    return F.when(lost, F.struct(F.lit(name).alias("key"), scraped.cast("string").alias("value")))


def typed_overwrite(new: DataFrame, target: T.StructType) -> DataFrame:
    """Scraped columns in the stored types.

    Text that does not fit its type leaves the typed column NULL and is kept,
    as scraped, in the map ``uncast_values``.
    """
    types = {f.name: f.dataType for f in target.fields}
    columns, failures = [], []
    for c in new.columns:
        column = F.col(f"`{c}`")
        dtype = types.get(c)
        if dtype is None or new.schema[c].dataType == dtype:
            columns.append(column)
            continue
        value = fitted(column, dtype)
        columns.append(value.alias(c))
        failures.append(_uncast(c, column, value))
    if failures:
        columns.append(F.map_from_entries(F.array_compact(F.array(*failures))).alias(UNCAST))
    return new.select(*columns)


def refresh_columns(
    stored: DataFrame, fetched: DataFrame, columns: Sequence[str], key: str = "URL"
) -> DataFrame:
    """Overwrite ``columns`` only where a new value was fetched."""
    present = [c for c in columns if c in fetched.columns]
    latest = keep_last_by_key(fetched.where(F.col(key).isNotNull()), key).select(
        F.col(key).alias("__key"), *[F.col(c).alias(f"__new_{c}") for c in present]
    )
    joined = stored.join(latest, F.col(key) == F.col("__key"), "left")
    updated = {
        c: F.coalesce(F.col(f"__new_{c}"), F.col(c) if c in stored.columns else F.lit(None)) for c in present
    }
    return joined.withColumns(updated).drop("__key", *[f"__new_{c}" for c in present])
