"""HTML extraction with built-in string functions, so page parsing stays inside the JVM.

The helpers look for *elements by tag and class / attribute*; nesting of an element inside itself is out of scope
(stat tables and listing rows do not nest).
"""

from __future__ import annotations

import html.entities
import json

from pyspark.sql import Column
from pyspark.sql import functions as F

from statquarry.functions.parsing import MISSING, strip_space

UNREAD = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
TAG = r"(?s)<[^>]*>"
_PIECE = r"&#?\w+;|[^&]+|&"


def readable(page: Column) -> Column:
    """The page without comments, scripts and style sheets, whose text may look like tags."""
    return F.regexp_replace(page, UNREAD, "")


def _entity_table() -> Column:
    """Named entities known to the standard library, as one literal that folds to a constant map."""
    table = {f"&{name};": chr(code) for name, code in html.entities.name2codepoint.items()} | {"&apos;": "'"}
    return F.from_json(F.lit(json.dumps(table)), "map<string,string>")


def _from_code(code: Column) -> Column:
    return F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")


def decode_entities(text: Column) -> Column:
    """``&amp;``, ``&#39;``, ``&#x27;`` to characters, each token decoded once; unknown entities stay as they are.

    ``text`` appears once in the result, so a costly expression behind it is evaluated once.
    """
    table = _entity_table()

    def piece(p: Column) -> Column:
        decimal = F.regexp_extract(p, r"^&#(\d{1,7});$", 1)
        hexa = F.regexp_extract(p, r"^&#[xX]([0-9a-fA-F]{1,6});$", 1)
        return (
            F.when(decimal != "", _from_code(decimal.try_cast("bigint")))
            .when(hexa != "", _from_code(F.conv(hexa, 16, 10).try_cast("bigint")))
            .when(p.startswith("&"), F.coalesce(F.try_element_at(table, p), p))
            .otherwise(p)
        )

    return F.array_join(F.transform(F.regexp_extract_all(text, F.lit(_PIECE), F.lit(0)), piece), "")


def element_text(markup: Column) -> Column:
    """All text below an element, entities decoded, outer white space removed."""
    return strip_space(decode_entities(F.regexp_replace(markup, TAG, "")))


def compact_text(markup: Column) -> Column:
    """Text nodes trimmed one by one and joined without a separator."""
    nodes = F.transform(F.split(markup, TAG), lambda node: strip_space(decode_entities(node)))
    return F.array_join(nodes, "")


def _open_tag(tag: str, cls: str | None = None, attrs: dict[str, str] | None = None) -> str:
    """Regex for an opening tag; ``cls`` may name several blank-separated classes, all required."""
    parts = []
    for name in (cls or "").split():
        parts.append(rf"""(?=[^>]*\bclass\s*=\s*(?:"(?:[^"]*\s)?{name}[\s"]|'(?:[^']*\s)?{name}[\s']))""")
    for key, value in (attrs or {}).items():
        parts.append(rf"""(?=[^>]*[\s"']{key}\s*=\s*["']{value}["'])""")
    return rf"<{tag}\b{''.join(parts)}[^>]*>"


def elements(page: Column, tag: str, cls: str | None = None, attrs: dict[str, str] | None = None) -> Column:
    """Array of whole ``<tag …>…</tag>`` elements in document order."""
    return F.regexp_extract_all(page, F.lit(f"(?is){_open_tag(tag, cls, attrs)}.*?</{tag}\\s*>"), F.lit(0))


def first_element(page: Column, tag: str, cls: str | None = None, attrs: dict[str, str] | None = None) -> Column:
    """First such element, NULL when there is none."""
    found = F.regexp_extract(page, f"(?is){_open_tag(tag, cls, attrs)}.*?</{tag}\\s*>", 0)
    return F.nullif(found, F.lit(""))


def first_opening(page: Column, tag: str, cls: str | None = None) -> Column:
    """First opening tag alone; enough for attributes, and the only form of void elements such as ``meta``."""
    return F.nullif(F.regexp_extract(page, f"(?is){_open_tag(tag, cls)}", 0), F.lit(""))


def attribute(element: Column, name: str) -> Column:
    """Attribute of the element's own opening tag, entities decoded; NULL when absent."""
    pattern = rf"""(?is)^<[^>]*?\s{name}\s*=\s*(["'])(.*?)\1"""
    return decode_entities(F.try_element_at(F.regexp_extract_all(element, F.lit(pattern), F.lit(2)), F.lit(1)))


def path_element(row: Column, steps: list[tuple[str, str | None]]) -> Column:
    """Element reached by nested (tag, class) steps, e.g. ``[("td", "td-player"), ("a", None)]``.

    An outer step only moves the start of the search, so an outer element that holds several siblings of its own
    tag is not cut short at the first closing tag.
    """
    *outer, last = steps
    prefix = "".join(f"{_open_tag(tag, cls)}.*?" for tag, cls in outer)
    found = F.regexp_extract(row, f"(?is){prefix}({_open_tag(*last)}.*?</{last[0]}\\s*>)", 1)
    return F.nullif(found, F.lit(""))


def text_or(element: Column, default: str = MISSING, compact: bool = True) -> Column:
    """Element text, ``default`` when the element is absent (a blank element gives ``''``)."""
    return F.coalesce(compact_text(element) if compact else element_text(element), F.lit(default))


def attribute_or(element: Column, name: str, default: str = MISSING) -> Column:
    return F.coalesce(attribute(element, name), F.lit(default))
