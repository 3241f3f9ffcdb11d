"""Listing fields out of page HTML, by regular expressions on the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Markup that is read.
_TITLE = r"(?is)<h1\b[^>]*>(.*?)</h1>"
# a paragraph ends at its tag or where the next block starts
_PARAGRAPH = r"(?is)<p\b(?![^>]*class=[\"'][^\"']*\bsmall\b)[^>]*>(.*?)(?=</?p\b|</article|</div|</section|<ul\b|$)"
_ITEM = r"(?is)<li\b[^>]*>(.*?)(?=</li|<li\b|</ul|$)"
_LINK = r"(?is)<a\b[^>]*\bhref=[\"']([^\"']*)[\"']"
_SPEC = r"(?is)<td\b[^>]*class=[\"'][^\"']*\blabel\b[^>]*>(.*?)</td>\s*<td\b[^>]*class=[\"'][^\"']*\bcontent\b[^>]*>(.*?)</td>"
_PRICE = r"(?is)class=[\"'][^\"']*\bprice\b[^>]*>.*?<span\b[^>]*class=[\"']p[\"'][^>]*>(.*?)</span>"
_HIDDEN = r"(?is)<(script|style)\b.*?</\1>|<!--.*?-->"


def decoded(text: Column) -> Column:
    """Common entities as characters."""
    for entity, character in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        text = F.replace(text, F.lit(entity), F.lit(character))
    return text


def plain_text(html: Column) -> Column:
    """Markup removed, common entities decoded, ends stripped."""
    return F.regexp_replace(decoded(F.regexp_replace(html, r"(?s)<[^>]*>", "")), r"(?U)^\s+|\s+$", "")


def extract_listings(pages: DataFrame, html: str = "html") -> DataFrame:
    """Title, description paragraphs, bullet items, links, spec map and price of every page."""
    body = F.regexp_replace(F.col(html), _HIDDEN, "")

    def texts(pattern: str) -> Column:
        return F.transform(F.regexp_extract_all("__body", F.lit(pattern), 1), plain_text)

    specs = F.transform(
        F.arrays_zip(
            F.regexp_extract_all("__body", F.lit(_SPEC), 1).alias("label"),
            F.regexp_extract_all("__body", F.lit(_SPEC), 2).alias("content"),
        ),
        lambda pair: F.struct(
            F.regexp_replace(plain_text(pair["label"]), ":+$", "").alias("key"), plain_text(pair["content"]).alias("value")
        ),
    )
    # a label met again takes the later value, so later pairs come first and win
    unique = F.aggregate(
        specs,
        F.array().cast("array<struct<key: string, value: string>>"),
        lambda kept, pair: F.concat(F.filter(kept, lambda k: k["key"] != pair["key"]), F.array(pair)),
    )
    price = F.regexp_extract("__body", _PRICE, 1)
    return (
        pages.withColumn("__body", body)
        .withColumns(
            {
                "Title": F.nullif(plain_text(F.regexp_extract("__body", _TITLE, 1)), F.lit("")),
                "paragraphs": texts(_PARAGRAPH),
                "items": texts(_ITEM),
                "links": F.regexp_extract_all("__body", F.lit(_LINK), 1),
                "specs": F.map_from_entries(unique),
                "Price": F.nullif(plain_text(price), F.lit("")),
            }
        )
        .withColumn("Description", F.nullif(F.array_join("paragraphs", "\n"), F.lit("")))
        .withColumn("Secondary_Description", F.nullif(F.array_join("items", "\n"), F.lit("")))
        .drop("__body")
    )
