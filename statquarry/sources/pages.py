"""Saved web pages to rows.

Input everywhere is ``pages(page_id bigint, url string, html string)``.  Fetching pages is not part of the library.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statquarry.functions.markup import (
    attribute,
    attribute_or,
    element_text,
    elements,
    first_element,
    first_opening,
    path_element,
    readable,
    text_or,
)
from statquarry.functions.parsing import MISSING
from statquarry.operators.ordering import running_number
from statquarry.operators.shape import drop_placeholders
from statquarry.session import materialise


def valid_pages(pages: DataFrame, tag: str = "table", element_id: str | None = None, row_tag: str = "tr") -> DataFrame:
    """Pages that hold the wanted element with more than one row; adds ``block`` (the element) and ``n_rows``.

    The element is found and tested inside one generator: a filter on it would be pushed below and search the page twice.
    """
    attrs = {"id": element_id} if element_id else None
    block = first_element(readable(F.col("html")), tag, attrs=attrs)
    count = F.lit(rf"(?i)<{row_tag}\b")
    found = F.transform(
        F.array(block), lambda b: F.struct(b.alias("block"), F.regexp_count(b, count).alias("n_rows"))
    )
    return pages.select(*[c for c in pages.columns if c != "html"], F.inline(F.filter(found, lambda f: f["n_rows"] > 1)))


def _cell_list(row: Column) -> Column:
    """All ``td`` of a row as ``(stat, text)`` structs, found in one pass over the row."""
    return F.transform(
        elements(row, "td"), lambda td: F.struct(attribute(td, "data-stat").alias("stat"), element_text(td).alias("text"))
    )


def table_blocks(pages: DataFrame, table_ids: Sequence[str]) -> DataFrame:
    """``page_id, table_id, block``: the wanted tables of each page, found in one pass over the page.

    A page's first table of an id counts, and only if it has more than one row.
    """
    tables = F.transform(
        elements(readable(F.col("html")), "table"),
        lambda t: F.struct(attribute(t, "id").alias("table_id"), t.alias("block")),
    )
    found = pages.select("page_id", tables.alias("tables"))
    ids = F.transform(F.col("tables"), lambda t: t["table_id"])
    first = F.filter(
        F.col("tables"),
        lambda t, i: t["table_id"].isin(list(table_ids)) & (F.array_position(ids, t["table_id"]) == i + 1),
    )
    return found.select("page_id", F.inline(first)).where(F.regexp_count("block", F.lit(r"(?i)<tr\b")) > 1)


def table_rows(blocks: DataFrame, table_id: str, fields: Sequence[str]) -> DataFrame:
    """``page_id, row_no, <fields>`` of the stat table with that id, from ``table_blocks``.

    Each ``tr`` without a column-header cell gives a row; each field is the trimmed text of its first
    ``td[data-stat=field]`` or ``'N/a'`` when the cell is absent.  ``row_no`` is ``(page_id, position)``, an orderable
    pair, so order survives any repartitioning.  Every step is narrow.
    """
    found = blocks.where(F.col("table_id") == table_id)
    rows = found.select("page_id", F.posexplode(elements(F.col("block"), "tr")).alias("position", "tr"))
    rows = rows.where(~F.col("tr").rlike(r"""(?is)<th\b[^>]*\sscope\s*=\s*["']?col["'\s>]"""))
    cells = rows.select("page_id", "position", _cell_list(F.col("tr")).alias("cells"))

    def cell(field: str) -> Column:
        first = F.try_element_at(F.filter(F.col("cells"), lambda c: c["stat"] == field), F.lit(1))
        return F.coalesce(first["text"], F.lit(MISSING)).alias(field)

    return cells.select("page_id", F.struct("page_id", "position").alias("row_no"), *[cell(f) for f in fields])


def link_rows(pages: DataFrame, item_tag: str = "li") -> DataFrame:
    """``page_id, row_in_page, text, href`` of every linked list item."""
    items = F.posexplode(elements(readable(F.col("html")), item_tag)).alias("row_in_page", "item")
    link = first_element(F.col("item"), "a")
    return pages.select("page_id", items).select(
        "page_id",
        (F.col("row_in_page") + 1).cast("bigint").alias("row_in_page"),
        text_or(link).alias("text"),
        attribute_or(link, "href").alias("href"),
    )


def listing_rows(
    pages: DataFrame,
    body_id: str,
    texts: Mapping[str, Sequence[tuple[str, str | None]]],
    attributes: Mapping[str, tuple[Sequence[tuple[str, str | None]], str]] | None = None,
) -> DataFrame:
    """``page_id, row_in_page, <texts>, <attributes>`` of each row of the ``tbody`` with that id.

    A path is a list of (tag, classes) steps whose first step is the table cell; a missing element gives ``'N/a'``.
    """
    body = first_element(readable(F.col("html")), "tbody", attrs={"id": body_id})
    rows = pages.select("page_id", F.posexplode(elements(body, "tr")).alias("row_in_page", "tr"))

    paths = [*texts.values(), *[path for path, _ in (attributes or {}).values()]]
    cells = {cell: f"cell{i}" for i, cell in enumerate(dict.fromkeys(tuple(path[0]) for path in paths))}
    rows = rows.select("page_id", "row_in_page", *[first_element(F.col("tr"), *c).alias(n) for c, n in cells.items()])

    def reach(path: Sequence[tuple[str, str | None]]) -> Column:
        cell, *inner = path
        outer = F.col(cells[tuple(cell)])
        return path_element(outer, list(inner)) if inner else outer

    return rows.select(
        "page_id",
        (F.col("row_in_page") + 1).cast("bigint").alias("row_in_page"),
        *[text_or(reach(path)).alias(name) for name, path in texts.items()],
        *[attribute_or(reach(path), attr).alias(name) for name, (path, attr) in (attributes or {}).items()],
    )


def labelled_value(
    pages: DataFrame,
    label: str,
    block: tuple[str, str | None],
    label_at: tuple[str, str | None] | None,
    value_at: tuple[str, str | None] | None,
) -> DataFrame:
    """``page_id, url, value``: from the first block whose label text contains ``label``, the text of its value element.

    ``label_at`` / ``value_at`` of ``None`` mean the block itself.  A block lacking either element is passed over.
    """
    def part(b: Column, at: tuple[str, str | None] | None) -> Column:
        return b if at is None else first_element(b, *at)

    def usable(b: Column) -> Column:
        wanted = element_text(part(b, label_at)).contains(label) & part(b, value_at).isNotNull()
        return F.coalesce(wanted, F.lit(False))

    hits = F.filter(elements(readable(F.col("html")), *block), usable)
    return pages.select(
        "page_id", "url", element_text(part(F.try_element_at(hits, F.lit(1)), value_at)).alias("value")
    )


def page_fields(pages: DataFrame, fields: Mapping[str, tuple[str, str | None, str | None]]) -> DataFrame:
    """``page_id`` and per name the text (or an attribute) of the first matching element, ``'N/a'`` when absent.

    ``fields`` maps a name to (tag, classes, attribute); attribute ``None`` means the element's text.
    """
    page = F.col("page")

    def value(tag: str, cls: str | None, attr: str | None) -> Column:
        return text_or(first_element(page, tag, cls)) if attr is None else attribute_or(first_opening(page, tag, cls), attr)

    cleaned = pages.select("page_id", readable(F.col("html")).alias("page"))
    return cleaned.select("page_id", *[value(*spec).alias(name) for name, spec in fields.items()])


def in_scrape_order(rows: DataFrame, entity: str, placeholders: Sequence[str] = ("", MISSING)) -> DataFrame:
    """Rows with a real entity name, numbered from 1 without gaps in page and row order.

    Numbering reads the rows three times; they are written once first, so pages are parsed once.
    """
    return running_number(materialise(drop_placeholders(rows, entity, placeholders)), "page_id", "row_in_page")
