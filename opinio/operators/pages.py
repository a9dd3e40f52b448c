"""Review extraction from stored pages (W1-W4, T9), as regex jobs over a pages table.

Site markup is data, not code: each extracted field is a (name, pattern)
rule. Patterns use one capture group and no look-behind, so they read the
same in Java and RE2.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Default rules for the pages table's markup.
PAGE_RULES = {
    "lang": r'<html lang="([^"]*)"',
    "title": r"<title>([^<]*)</title>",
    "track_id": r"track\((\d+)\)",
}
LINK_HREF = r'<a href="([^"]*)">'
LINK_TEXT = r'<a href="[^"]*">([^<]*)</a>'


def page_scalars(pages: DataFrame, rules: Mapping[str, str] = PAGE_RULES,
                 html: str = "html", keep=("page_id",)) -> DataFrame:
    """One column per rule, the first match's group ('' when absent)."""
    return pages.select(*keep, *[F.regexp_extract(F.col(html), pat, 1).alias(name)
                                 for name, pat in rules.items()])


def extract_all(html: str, pattern: str):
    """Every match of the pattern's capture group, in document order."""
    return F.regexp_extract_all(F.col(html), F.lit(pattern), 1)


def repeated_elements(pages: DataFrame, pattern: str = LINK_HREF, html: str = "html",
                      keep=("page_id",), name: str = "value") -> DataFrame:
    """One row per repeated element, with its slot number (0-based)."""
    return pages.select(*keep, F.posexplode(extract_all(html, pattern)).alias("slot", name))


def align_fields(pages: DataFrame, fields: Mapping[str, str], html: str = "html",
                 keep=("page_id",)) -> DataFrame:
    """Several repeated fields aligned by position into one row per slot.

    A field with fewer matches than the others is null in the extra slots.
    """
    zipped = F.arrays_zip(*[extract_all(html, p).alias(n) for n, p in fields.items()])
    return (pages.select(*keep, F.posexplode(zipped).alias("slot", "z"))
            .select(*keep, "slot", *[F.col("z").getField(n).alias(n) for n in fields]))
