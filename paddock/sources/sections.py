"""Fields of a page by the sections they stand in: markup cut into events, folded with a stack of open elements.

A paragraph ends at its tag or where the next block starts; a list item, row or cell ends where the next of its kind
starts in the same list, row or table. Text is read node by node, each stripped, then joined. A null page, and an
element that a page does not have, give nulls and empty arrays.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from paddock.sources.pages import decoded

# Elements that are followed, and those among them that end an open paragraph.
_INLINE = ["span", "td", "th", "tr", "li"]
_BLOCKS = ["section", "article", "nav", "header", "footer", "main", "aside", "div", "p", "ul", "ol", "table", "h1", "h2", "h3", "h4"]

#: A comment, a script or style with its content, a tag, or a run of text.
_EVENT = r"(?is)<!--.*?(?:-->|$)|<(script|style)\b.*?(?:</\1\s*>|$)|<[/a-z!?](?:[^>\"']|\"[^\"]*\"|'[^']*')*>|[^<]+|<"
_TAG = r"(?is)^<(/?)([a-z][a-z0-9]*)\b"
_OPEN = "array<struct<n: int, tag: string, id: string, class: string, start: int>>"
_FOUND = "array<struct<n: int, tag: string, id: string, class: string, start: int, stop: int, path: array<int>>>"

Step = tuple[str, str | None, str | None]


def _free(name: str, taken: list[str]) -> str:
    """A column name that is not taken, whatever its case."""
    while name.lower() in [t.lower() for t in taken]:
        name += "_"
    return name


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _attribute(markup: Column, name: str) -> Column:
    quoted = F.regexp_extract(markup, rf"(?is)\s{name}\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", 0)
    return decoded(F.regexp_replace(quoted, r"(?is)^\s[a-z]+\s*=\s*[\"']?|[\"']$", ""))


def _event(markup: Column, at: Column) -> Column:
    name = F.lower(F.regexp_extract(markup, _TAG, 2))
    text = F.when(markup.startswith("<") & (F.length(markup) > 1), "").otherwise(_stripped(decoded(markup)))
    return F.struct(
        at.cast("int").alias("n"),
        (F.regexp_extract(markup, _TAG, 1) == "/").alias("closes"),
        F.when(name.isin(_INLINE + _BLOCKS), name).otherwise("").alias("tag"),
        _attribute(markup, "id").alias("id"),
        F.trim(F.regexp_replace(_attribute(markup, "class"), r"\s+", " ")).alias("class"),
        text.alias("text"),
    )


def _stripped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def _ended(tags: Column, event: Column) -> Column:
    """How many open elements, innermost first, the event ends."""

    def up_to(kinds: list[str], fence: list[str]) -> Column:
        nearest = F.get(F.filter(tags, lambda t: t.isin(kinds + fence)), F.lit(0))
        return F.when(nearest.isin(kinds), F.array_position(tags, nearest)).otherwise(0)

    own = (
        F.when(event["tag"] == "li", up_to(["li"], ["ul", "ol"]))
        .when(event["tag"].isin("td", "th"), up_to(["td", "th"], ["tr", "table"]))
        .when(event["tag"] == "tr", up_to(["tr"], ["table"]))
        .otherwise(0)
    )
    paragraph = F.when(event["tag"].isin(_BLOCKS), up_to(["p"], [])).otherwise(0)
    return F.when(event["closes"], F.array_position(tags, event["tag"])).otherwise(F.greatest(own, paragraph)).cast("int")


def _step(state: Column, event: Column) -> Column:
    def moved(ended: Column) -> Column:
        opened, stack = state["stack"], F.slice(state["stack"], ended + 1, F.size(state["stack"]))
        closed = F.transform(
            F.slice(opened, F.lit(1), ended),
            lambda e, i: F.struct(
                e["n"], e["tag"], e["id"], e["class"], e["start"], state["texts"].alias("stop"),
                F.slice(opened, i + 1, F.size(opened))["n"].alias("path"),
            ),
        )
        entry = F.struct(event["n"], event["tag"], event["id"], event["class"], state["texts"].alias("start"))
        return F.struct(
            F.when(event["closes"], stack).otherwise(F.concat(F.array(entry), stack)).cast(_OPEN).alias("stack"),
            F.when(ended > 0, F.concat(state["found"], closed)).otherwise(state["found"]).cast(_FOUND).alias("found"),
            state["texts"].alias("texts"),
        )

    counted = F.struct(state["stack"], state["found"], (state["texts"] + 1).alias("texts"))
    tagged = _let(_ended(state["stack"]["tag"], event), moved)
    return F.when(event["text"] != "", counted).when(event["tag"] != "", tagged).otherwise(state)


def page_elements(pages: DataFrame, html: str, elements: str, texts: str) -> DataFrame:
    """Adds the followed elements in page order, each with the elements around it, and the page's text nodes.

    An element holds the text nodes from ``start`` to before ``stop``; ``path`` names it and those around it by ``n``.
    Elements left open end with the page.
    """
    events = _free("events", pages.columns)
    cut = pages.withColumn(events, F.transform(F.regexp_extract_all(F.col(f"`{html}`"), F.lit(_EVENT), 0), _event))
    root = F.struct(F.lit(-1), F.lit("page"), F.lit(""), F.lit(""), F.lit(0))
    start = F.struct(
        F.array(root).cast(_OPEN).alias("stack"), F.array().cast(_FOUND).alias("found"), F.lit(0).alias("texts")
    )
    end = F.struct(
        F.lit(-1).alias("n"), F.lit(True).alias("closes"), F.lit("page").alias("tag"), F.lit("").alias("id"),
        F.lit("").alias("class"), F.lit("").alias("text"),
    )
    found = F.aggregate(F.concat(events, F.array(end)), start, _step, lambda state: F.array_sort(state["found"]))
    nodes = F.filter(F.transform(events, lambda e: e["text"]), lambda t: t != "")
    return cut.withColumns({elements: found, texts: nodes}).drop(events)


def is_like(element: Column, step: Step) -> Column:
    """Whether an element has the step's tag, id and class; a class of several words must be the whole attribute."""
    tag, name, style = step
    test = element["tag"] == tag
    if name is not None:
        test = test & (element["id"] == name)
    if style is not None:
        test = test & (element["class"] == style if " " in style else has_class(element, style))
    return test


def has_class(element: Column, style: str) -> Column:
    return F.array_contains(F.split(element["class"], " "), style)


def first_below(elements: Column, *steps: Step) -> Column:
    """The first element like the first step, the first like the second step inside it, and so on; null without one."""

    def next_below(found: Column, step: Step) -> Column:
        return _let(found, lambda outer: F.get(F.filter(elements, lambda e: inside(e, outer) & is_like(e, step)), F.lit(0)))

    return reduce(next_below, steps[1:], F.get(F.filter(elements, lambda e: is_like(e, steps[0])), F.lit(0)))


def inside(element: Column, outer: Column) -> Column:
    return F.array_contains(element["path"], outer["n"]) & (element["n"] != outer["n"])


def directly_inside(element: Column, outer: Column) -> Column:
    return F.get(element["path"], F.lit(1)) == outer["n"]


def text_of(element: Column, texts: Column) -> Column:
    return F.array_join(F.slice(texts, element["start"] + 1, element["stop"] - element["start"]), "")


def paragraphs_of(elements: Column, texts: Column, outer: Column) -> Column:
    """Texts of all paragraphs inside an element, those of small print left out."""
    wanted = F.filter(elements, lambda e: inside(e, outer) & (e["tag"] == "p") & ~has_class(e, "small"))
    return F.transform(wanted, lambda e: text_of(e, texts))


def paragraphs_and_items(elements: Column, texts: Column, outer: Column) -> Column:
    """Texts of the paragraphs and of the items of the lists that stand directly in an element, in page order."""
    lists = F.filter(elements, lambda e: directly_inside(e, outer) & (e["tag"] == "ul"))
    wanted = F.filter(
        elements,
        lambda e: ((e["tag"] == "p") & directly_inside(e, outer) & ~has_class(e, "small"))
        | ((e["tag"] == "li") & F.exists(lists, lambda u: inside(e, u))),
    )
    return F.transform(wanted, lambda e: text_of(e, texts))


def extract_sections(pages: DataFrame, html: str = "html") -> DataFrame:
    """Title, descriptions, spec map and price, each read only in its own section of a listing page.

    The first description takes the paragraphs of the overview's main column; the second the paragraphs and list items
    of the first other column of the main content that has any; specs the label and content cells of the data tables,
    where a label met again takes the later value.
    """
    elements, texts = _free("elements", pages.columns), _free("texts", pages.columns)
    found, nodes = F.col(elements), F.col(texts)
    overview = first_below(
        found, ("section", "overview_anchor", None), ("div", None, "col-xs-12 col-md-8"), ("div", None, "content")
    )
    main = first_below(found, ("section", None, "maincontent"))

    def second(outer: Column) -> Column:
        rows = F.filter(found, lambda e: inside(e, outer) & is_like(e, ("div", None, "row")))
        columns = F.filter(
            found,
            lambda e: is_like(e, ("div", None, "col-xs-12")) & ~has_class(e, "col-md-8") & F.exists(rows, lambda r: inside(e, r)),
        )
        read = F.transform(
            columns,
            lambda c: _let(
                F.get(F.filter(found, lambda e: inside(e, c) & is_like(e, ("div", None, "content"))), F.lit(0)),
                lambda box: F.array_join(paragraphs_and_items(found, nodes, box), "\n"),
            ),
        )
        return F.get(F.filter(read, lambda t: t != ""), F.lit(0))

    def cell(row: Column, style: str) -> Column:
        return F.get(F.filter(found, lambda e: inside(e, row) & is_like(e, ("td", None, style))), F.lit(0))

    tables = F.filter(found, lambda e: is_like(e, ("table", None, "fahrzeugdaten")))
    rows = F.filter(found, lambda e: (e["tag"] == "tr") & F.exists(tables, lambda t: inside(e, t)))
    pairs = F.filter(
        F.transform(rows, lambda r: F.struct(cell(r, "label").alias("label"), cell(r, "content").alias("content"))),
        lambda p: p["label"].isNotNull() & p["content"].isNotNull(),
    )
    specs = F.transform(
        pairs,
        lambda p: F.struct(
            F.regexp_replace(text_of(p["label"], nodes), ":+$", "").alias("key"), text_of(p["content"], nodes).alias("value")
        ),
    )
    latest = F.filter(specs, lambda s, i: ~F.array_contains(F.slice(specs["key"], i + 2, F.size(specs)), s["key"]))
    bars = F.filter(found, lambda e: is_like(e, ("div", None, "sidebar-section")))
    prices = F.filter(found, lambda e: has_class(e, "price") & F.exists(bars, lambda b: inside(e, b)))
    price = F.get(
        F.filter(found, lambda e: is_like(e, ("span", None, "p")) & F.exists(prices, lambda p: inside(e, p))), F.lit(0)
    )
    empty = F.lit("")
    fields = {
        "Title": _let(first_below(found, ("h1", None, None)), lambda e: text_of(e, nodes)),
        "Description": F.nullif(_let(overview, lambda e: F.array_join(paragraphs_of(found, nodes, e), "\n")), empty),
        "Secondary_Description": _let(main, second),
        "specs": F.map_from_entries(latest),
        "Price": _let(price, lambda e: text_of(e, nodes)),
    }
    kept = [F.col(f"`{c}`") for c in pages.columns if c not in fields]
    return page_elements(pages, html, elements, texts).select(*kept, *[value.alias(name) for name, value in fields.items()])
