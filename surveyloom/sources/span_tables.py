"""Poll tables: plain ones (A1), with party cells that span columns (A2), and with states that head groups of rows (A3).

Python only takes the cells out of the HTML, a page at a time; what they mean is column expressions.
"""

from __future__ import annotations

from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.survey import day_first, digits
from ..vocab import ELECTION_STATES

_CELL = pa.struct([("text", pa.string()), ("title", pa.string()), ("span", pa.int32()), ("head", pa.bool_())])
_CELLS = "page_id long, tab int, row int, heads array<string>, group_id string, cells array<struct<text:string,title:string,span:int,head:boolean>>"


class _Cells(HTMLParser):
    """Per table of a class: the header texts and, per body row, (id of its group header, cells)."""

    def __init__(self, css: str):
        super().__init__(convert_charrefs=True)
        self.css, self.tables, self.depth, self.part, self.into = css, [], 0, "", None

    def handle_starttag(self, tag, attrs):
        named = {k: v or "" for k, v in attrs}
        if tag == "table":
            if self.depth or self.css in named.get("class", "").split():
                self.depth += 1
                if self.depth == 1:
                    self.tables.append(([], []))
                    self.part, self.into = "", None
            return
        if self.depth != 1:
            return
        heads, rows = self.tables[-1]
        if tag in ("thead", "tbody"):
            self.part, self.into = tag, None
        elif tag == "tr" and self.part != "thead":
            rows.append([None, []])
            self.into = None
        elif tag == "th" and self.part == "thead":
            self.into = []
            heads.append(self.into)
        elif tag in ("td", "th") and self.part != "thead" and rows:
            if tag == "th" and rows[-1][0] is None and "li" in named.get("class", "").split():
                rows[-1][0] = named.get("id", "")
            span, self.into = named.get("colspan", "1").strip(), []
            rows[-1][1].append((self.into, named.get("title", ""), int(span) if span.isdecimal() and len(span) < 5 else 1, tag == "th"))

    def handle_endtag(self, tag):
        if tag == "table" and self.depth:
            self.depth -= 1
        elif self.depth == 1 and tag in ("td", "th"):
            self.into = None
        elif self.depth == 1 and tag in ("thead", "tbody"):
            self.part = ""

    def handle_data(self, data):
        if self.into is not None:
            self.into.append(data)


def table_cells(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", css: str = "wilko") -> DataFrame:
    """(page_id, tab, row, heads, group_id, cells) of each body row; the pieces of a cell's text are separated by line ends.

    tab and row count from 0 in the page and the table.  Null pages and pages without such a table give no rows.
    """

    def run(batches):
        for batch in batches:
            for page, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                parser = _Cells(css)
                parser.feed(html or "")
                out = [
                    {"page_id": page, "tab": t, "row": r, "heads": ["\n".join(h) for h in heads], "group_id": group, "cells": [{"text": "\n".join(text), "title": title, "span": span, "head": head} for text, title, span, head in cells]}
                    for t, (heads, rows) in enumerate(parser.tables)
                    for r, (group, cells) in enumerate(rows)
                ]
                if out:
                    yield pa.RecordBatch.from_pylist(out, schema=pa.schema([("page_id", pa.int64()), ("tab", pa.int32()), ("row", pa.int32()), ("heads", pa.list_(pa.string())), ("group_id", pa.string()), ("cells", pa.list_(_CELL))]))

    return pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(html_col).alias("html")).mapInArrow(run, _CELLS)


def one_line(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"[\s\x{A0}]+", " "))


def _results(cells: Column, fixed: int) -> Column:
    """(party, value) of the cells after the fixed ones, each under the header where it begins; cells past the last header and empty cells have none."""
    party = F.slice(cells, fixed + 1, F.greatest(F.size(cells) - fixed, F.lit(0)))

    def one(cell: Column, i: Column) -> Column:
        at = F.aggregate(F.slice(party, 1, i), F.lit(0), lambda n, c: n + c["span"])
        both = (cell["span"] == 2) & F.coalesce((F.get("names", at) == "CDU") & (F.get("names", at + 1) == "CSU"), F.lit(False))
        return F.struct(F.when(both, "CDU/CSU").otherwise(F.get("names", at)).alias("party"), one_line(cell["text"]).alias("value"))

    return F.filter(F.transform(party, one), lambda r: r["party"].isNotNull() & (r["value"] != ""))


def _named(rows: DataFrame) -> DataFrame:
    """names: the party headers, which follow six others."""
    heads = F.transform("heads", one_line)
    return rows.withColumn("names", F.filter(F.slice(heads, 7, F.greatest(F.size(heads) - 6, F.lit(0))), lambda h: h != ""))


def _text(i: int) -> Column:
    return one_line(F.get("cells", F.lit(i))["text"])


#: Columns of a plain table that are no party results.
FIXED_HEADERS = ("Institut", "Auftraggeber", "Befragte", "Datum", "Zeitraum")


def plain_tables(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """A1: (page_id, tab, row, fields map, parties map) of the rows that hold a party result.

    Headers are those of thead, else the cells of the first row; an empty first one is
    ``Datum``.  A row of fewer data cells than headers gives nothing.  Of columns that share a
    header the last filled one counts.
    """
    rows = table_cells(pages, id_col, html_col)
    # A partition is one table of one page.
    first = F.first("cells").over(Window.partitionBy("page_id", "tab").orderBy("row"))
    rows = rows.withColumn("first", first).withColumn("bare", F.size("heads") == 0)
    names = F.when(F.col("bare"), F.transform("first", lambda c: one_line(c["text"]))).otherwise(F.transform("heads", one_line))
    names = F.transform(names, lambda h, i: F.when((i == 0) & (h == ""), "Datum").otherwise(h))
    texts = F.transform(F.filter("cells", lambda c: ~c["head"]), lambda c: one_line(c["text"]))
    rows = rows.withColumns({"names": names, "texts": texts}).filter(~(F.col("bare") & (F.col("row") == 0)) & (F.size("texts") >= F.size("names")) & (F.size("names") > 0))
    pairs = F.zip_with("names", F.slice("texts", 1, F.size("names")), lambda name, text: F.struct(name.alias("key"), text.alias("value")))
    fixed = F.array(*[F.lit(h) for h in FIXED_HEADERS])

    def as_map(keep) -> Column:
        kept = F.filter("pairs", keep)
        return F.map_from_entries(F.filter(kept, lambda p, i: ~F.exists(F.slice(kept, i + 2, F.size(kept)), lambda q: q["key"] == p["key"])))

    rows = rows.withColumn("pairs", pairs)
    rows = rows.withColumns({"fields": as_map(lambda p: F.array_contains(fixed, p["key"])), "parties": as_map(lambda p: ~F.array_contains(fixed, p["key"]) & (p["value"] != ""))})
    return rows.filter(F.size("parties") > 0).select("page_id", "tab", "row", "fields", "parties")


def spanned_tables(pages: DataFrame, tables: tuple[int, ...] = (0, 1), id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """A2: (page_id, tab, row, institute, client, date, respondents, results) of rows that begin with a date (dd.mm.yyyy) and hold a result.

    Rows of fewer than seven cells, and rows without a party value, give nothing; an empty client is null.
    """
    rows = _named(table_cells(pages, id_col, html_col).filter(F.col("tab").isin(*tables) & (F.size("cells") >= 7)))
    rows = rows.filter(_text(0).rlike(r"^\d{2}\.\d{2}\.\d{4}$")).withColumn("results", _results(F.col("cells"), 6)).filter(F.size("results") > 0)
    return rows.select("page_id", "tab", "row", _text(2).alias("institute"), F.nullif(_text(3), F.lit("")).alias("client"), _text(0).alias("date"), _text(4).alias("respondents"), "results")


def bracketed_end(text: Column) -> tuple[Column, Column]:
    """(what stands before the last bracket, what stands in it) of a text that ends with a closing one; the second is null for others."""
    inside = F.when(text.endswith(")"), F.substring_index(F.substring(text, F.lit(1), F.length(text) - 1), "(", -1))
    return F.trim(F.substring(text, F.lit(1), F.length(text) - F.length(inside) - 2)), inside


def holds_days(text: Column) -> Column:
    """Whether a line has days in it: two groups of digits with but a dot between them, or signs in place of unknown ones."""
    groups, gaps = digits(text)
    inner = F.slice(gaps, 2, F.greatest(F.size(groups) - 1, F.lit(0)))
    return text.contains("??") | F.exists(inner, lambda g: g == ".") | F.exists(F.slice(gaps, 1, F.size(groups)), lambda g: g.endswith("?."))


def grouped_tables(pages: DataFrame, tables: tuple[int, ...] = (2,), id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """A3: (page_id, tab, row, state, institute, client, date, respondents, timeframe, results) of rows whose first cell ends in a date in brackets.

    A known state id heads its row, whose first two cells then are no data, and holds for the
    rows below it in the table; before the first one the state is BUND.  The third cell's last line is the
    time frame if it looks like one; the cell's title is appended to the respondents where it isn't part of them.
    """
    rows = table_cells(pages, id_col, html_col).filter(F.col("tab").isin(*tables))
    own = F.when(F.col("group_id").isin(*ELECTION_STATES), F.upper("group_id"))
    # A partition is one table of one page.
    above = Window.partitionBy("page_id", "tab").orderBy("row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("state", F.coalesce(F.last(own, ignorenulls=True).over(above), F.lit("BUND")))
    rows = rows.withColumn("cells", F.when(own.isNotNull(), F.slice("cells", 3, F.greatest(F.size("cells") - 2, F.lit(0)))).otherwise(F.col("cells")))
    named, date = bracketed_end(_text(0))
    rows = _named(rows.filter((F.size("cells") >= 5) & day_first(date).isNotNull())).withColumn("results", _results(F.col("cells"), 4)).filter(F.size("results") > 0)
    lines = F.filter(F.transform(F.split(F.get("cells", F.lit(2))["text"], r"\R"), one_line), lambda x: x != "")
    timed = F.coalesce(holds_days(F.element_at(F.when(F.size("lines") > 0, F.col("lines")), -1)), F.lit(False))
    rows = rows.withColumn("lines", lines).withColumn("timed", timed)
    said = F.array_join(F.when(F.col("timed"), F.slice("lines", 1, F.size("lines") - 1)).otherwise(F.col("lines")), " ")
    title = one_line(F.get("cells", F.lit(2))["title"])
    return rows.select(
        "page_id", "tab", "row", "state", named.alias("institute"), F.nullif(_text(1), F.lit("")).alias("client"), date.alias("date"),
        F.when((title == "") | F.contains(said, title), said).otherwise(F.trim(F.concat_ws(" ", said, title))).alias("respondents"), F.when(F.col("timed"), F.element_at("lines", -1)).otherwise("").alias("timeframe"), "results",
    )
