"""Scan of text tables for paths of someone's machine."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# Path styles that must not be published.
PATH_PATTERNS = {
    "windows_user": r"[A-Za-z]:\\+Users\\+",
    "windows_temp": r"[A-Za-z]:\\+.*\\+AppData\\+Local\\+Temp",
    "network_share": r"\\+NAS_[^\s\"']+",
    "mac_user": r"/Users/[^\s\"']+",
    "linux_home": r"/home/[^\s\"']+",
}


def path_leak_scan(df: DataFrame, key: str, text: str) -> DataFrame:
    """One row (key, finding) per text and path style found in it."""
    found = [
        F.when(F.col(text).rlike("(?idU)" + pattern), F.lit(name)) for name, pattern in PATH_PATTERNS.items()
    ]
    return df.select(key, F.explode(F.array_compact(F.array(*found))).alias("finding"))
