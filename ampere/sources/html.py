"""Landed HTML pages → rows.

Headings, paragraphs and list links come from the page's tag stream
(``tag_stream``), labelled values from ``regexp_extract`` — JVM-side, no Python.
Rate tables need a real tree walk (a heading's child count decides whether
it names a table, cells hold nested markup), so ``html_tables`` parses each
page with the standard library's ``html.parser`` inside ``mapInPandas``:
pages stay partitioned across tasks and only the per-page parse is Python.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ampere.functions.numeric import parse_numeric, strip_units
from ampere.sources import tag_stream

def element_texts(col: str, tag: str) -> Column:
    """The text of every ``tag`` element in order, by the tag stream: implied
    ends count, markup is left out, references are decoded."""
    return tag_stream.element_texts(F.col(col), tag)


def links(col: str) -> tuple[Column, Column]:
    """Targets and texts of the links that open a list item."""
    found = tag_stream.item_links(F.col(col))
    return F.transform(found, lambda x: x["href"]), F.transform(found, lambda x: x["text"])


def explode_all(df: DataFrame, arrays: Sequence[Column], names: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """Parallel arrays → one row per position, one column per array."""
    d = df.select(*keep, *[a.alias(f"_g{i}") for i, a in enumerate(arrays)])
    if len(names) == 1:
        e = d.select(*keep, F.posexplode("_g0").alias("pos", names[0]))
    else:
        z = F.arrays_zip(*[F.col(f"_g{i}") for i in range(len(names))])
        e = d.select(*keep, F.posexplode(z).alias("pos", "_z")).select(
            *keep, "pos", *[F.col("_z").getField(f"_g{i}").alias(n) for i, n in enumerate(names)]
        )
    return e.withColumn("pos", F.col("pos").cast("bigint"))


def html_headings(pages: DataFrame, col: str = "html", keep: Sequence[str] = ("page_id",)) -> DataFrame:
    return explode_all(pages, [element_texts(col, "h1")], ["heading"], list(keep))


def html_list_items(pages: DataFrame, col: str = "html", keep: Sequence[str] = ("page_id",)) -> DataFrame:
    return explode_all(pages, links(col), ["href", "text"], list(keep))


def extract_labelled(
    df: DataFrame,
    col: str,
    labels: dict[str, str],
    numeric: dict[str, Sequence[str]] | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """One column per label from a page (S12): ``labels`` maps output name →
    regex with one group; ``numeric`` maps output name → units to strip
    before a lenient number parse. One projection, no loop over rows."""
    numeric = numeric or {}
    outs = []
    for name, pat in labels.items():
        v = F.nullif(F.regexp_extract(F.col(col), pat, 1), F.lit(""))
        if name in numeric:
            v = parse_numeric(strip_units(v, numeric[name]))
        outs.append(v.alias(name))
    return df.select(*keep, *outs)


# ── rate tables (S11) ────────────────────────────────────────────────────────


class _TableParser(HTMLParser):
    """Collects h2 headings (first child + child count) and tables (rows of
    (tag, text) cells) in document order."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.headings: list[tuple[str, int]] = []
        self.tables: list[list[list[tuple[str, str]]]] = []
        self._h2_depth = 0
        self._h2_children: list[str] = []
        self._h2_first: str | None = None
        self._h2_text_open = False
        self._table_depth = 0
        self._row: list[tuple[str, str]] | None = None
        self._cell: list[str] | None = None
        self._cell_tag = ""
        self._depth_in_h2 = 0

    # headings --------------------------------------------------------------
    def handle_starttag(self, tag, attrs):
        if self._h2_depth:
            if self._depth_in_h2 == 0:
                self._h2_children.append("tag")
                if self._h2_first is None:
                    self._h2_first = self.get_starttag_text() or ""
                self._h2_text_open = False
            if tag not in ("br", "img", "hr", "meta", "input", "wbr"):
                self._depth_in_h2 += 1
        if tag == "h2":
            self._h2_depth = 1
            self._h2_children = []
            self._h2_first = None
            self._h2_text_open = False
            self._depth_in_h2 = 0
        elif tag == "table":
            self._table_depth += 1
            if self._table_depth == 1:
                self.tables.append([])
        elif tag == "tr" and self._table_depth == 1:
            self._row = []
        elif tag in ("td", "th") and self._row is not None:
            self._cell = []
            self._cell_tag = tag

    def handle_endtag(self, tag):
        if tag == "h2" and self._h2_depth:
            self._h2_depth = 0
            self.headings.append(((self._h2_first or "").strip(), len(self._h2_children)))
            return
        if self._h2_depth and self._depth_in_h2 > 0 and tag not in ("br", "img", "hr", "meta", "input", "wbr"):
            self._depth_in_h2 -= 1
            self._h2_text_open = False
        if tag in ("td", "th") and self._cell is not None and self._row is not None:
            self._row.append((self._cell_tag, "".join(self._cell)))
            self._cell = None
        elif tag == "tr" and self._row is not None and self._table_depth == 1:
            self.tables[-1].append(self._row)
            self._row = None
        elif tag == "table" and self._table_depth:
            self._table_depth -= 1

    def handle_data(self, data):
        if self._h2_depth and self._depth_in_h2 == 0:
            if not self._h2_text_open:
                self._h2_children.append("text")
                self._h2_text_open = True
                if self._h2_first is None:
                    self._h2_first = data
            elif self._h2_first is not None and len(self._h2_children) == 1 and self._h2_children[0] == "text":
                self._h2_first += data
        if self._cell is not None:
            self._cell.append(data)


TABLE_SCHEMA = (
    "page_id long, table_pos int, rate_type string, row_pos int, "
    "headers array<string>, cells array<string>"
)


def _parse_pages(batches: Iterator[pd.DataFrame], id_col: str, html_col: str) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        out = []
        for pid, html in zip(pdf[id_col], pdf[html_col]):
            if html is None:
                continue
            p = _TableParser()
            p.feed(html)
            p.close()
            # a heading names a table only when it has more than one child node
            names = [first for first, n in p.headings if n > 1]
            for tpos, (name, table) in enumerate(zip(names, p.tables)):
                if not table:
                    continue
                headers = [t for tag, t in table[0] if tag == "th"]
                for rpos, row in enumerate(table[1:]):
                    cells = [t for tag, t in row if tag == "td"]
                    out.append((pid, tpos, name, rpos, headers, cells))
        yield pd.DataFrame(out, columns=["page_id", "table_pos", "rate_type", "row_pos", "headers", "cells"])


def html_tables(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """Pages → one row per table body row: (page_id, table_pos, rate_type,
    row_pos, headers, cells). Headings and tables are matched by position,
    stopping at the shorter list; header/cell text is raw (cleaned later)."""
    src = pages.select(F.col(id_col).cast("long").alias(id_col), html_col)
    return src.mapInPandas(lambda it: _parse_pages(it, id_col, html_col), TABLE_SCHEMA)
