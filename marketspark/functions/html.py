"""Cutting rows and cells out of HTML text with regular expressions, in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Entities that occur in text cells.
_ENTITIES = {"&nbsp;": " ", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&amp;": "&"}


def text_of(fragment: Column) -> Column:
    """Visible text of a fragment: tags removed, entities decoded, spaces joined."""
    out = F.regexp_replace(fragment, "<[^>]*>", " ")
    for entity, char in _ENTITIES.items():
        out = F.replace(out, F.lit(entity), F.lit(char))
    return F.trim(F.regexp_replace(out, r"\s+", " "))


def table_rows(page: Column, css_class: str) -> Column:
    """Rows of every table with exactly this class, as an array of fragments."""
    tables = F.regexp_extract_all(
        page, F.lit(rf'(?is)<table[^>]*\bclass="{css_class}"[^>]*>(.*?)</table>'), F.lit(1)
    )
    return F.flatten(F.transform(tables, lambda t: F.regexp_extract_all(t, F.lit(r"(?is)<tr[^>]*>(.*?)</tr>"), F.lit(1))))


def cells(row: Column) -> Column:
    return F.regexp_extract_all(row, F.lit(r"(?is)<td[^>]*>(.*?)</td>"), F.lit(1))


def link_target(fragment: Column, contains: str = "") -> Column:
    """href of the first link whose target holds the given text, '' without one."""
    return F.regexp_extract(fragment, rf'(?is)<a[^>]*\bhref="([^"]*{contains}[^"]*)"', 1)


def link_text(fragment: Column, contains: str = "") -> Column:
    return text_of(F.regexp_extract(fragment, rf'(?is)<a[^>]*\bhref="[^"]*{contains}[^"]*"[^>]*>(.*?)</a>', 1))


def blind_text(page: Column, paragraph: str, inner: str = "") -> Column:
    """Text of the first ``blind`` span inside the paragraph of that class."""
    block = F.regexp_extract(page, rf'(?is)<p[^>]*\bclass="{paragraph}"[^>]*>(.*?)</p>', 1)
    if inner:
        block = F.regexp_extract(block, rf'(?is)<em[^>]*\bclass="{inner}"[^>]*>(.*?)</em>', 1)
    return text_of(F.regexp_extract(block, r'(?is)<span[^>]*\bclass="blind"[^>]*>(.*?)</span>', 1))
