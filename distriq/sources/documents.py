"""Documents as tables: markup, feeds, schedules in plain text, index files, workbooks.

Each reader takes a frame with a document id and its content and gives one row per record found, so documents are read
where they lie and a broken one costs itself only.
"""

from __future__ import annotations

import io
import re
import zipfile
import zlib
from collections.abc import Iterator
from typing import IO
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from distriq.functions.text import ANY_DATE, bare_id, bound, date_kind, date_of, find_dates, header_kinds, plain_amount, spaced_key, without_tags
from distriq.operators.nested import is_object

# Words that tell a header row from data.
HEADER_WORDS = ("ex-", "record", "pay", "amount", "distribution")


def html_rows(df: DataFrame, doc_id: str, markup: str) -> DataFrame:
    """(doc_id, table_no, row_no, headers, cells) of the data rows of all tables in a page; numbers from 0.

    A row of ``<th>`` cells only heads the rows after it, headers in lower case; a table without one is headed by its
    first row that has a header's words and no date. Rows before a header, and rows without cells, are left out. Nested
    tables aren't told apart. NULL pages give nothing.
    """
    table, row, cell = r"(?is)<table[^>]*>(.*?)</table>", r"(?is)<tr[^>]*>(.*?)</tr>", r"(?is)<t[hd][^>]*>(.*?)</t[hd]>"
    tables = df.select(F.col(doc_id), F.posexplode(F.regexp_extract_all(markup, F.lit(table), 1)).alias("table_no", "__t"))

    def read(source: Column, i: Column) -> Column:
        only_th = source.rlike(r"(?i)<th[^>]*>") & ~source.rlike(r"(?i)<td[^>]*>")
        cells = F.transform(F.regexp_extract_all(source, F.lit(cell), 1), lambda c: without_tags(c))
        return bound(cells, lambda c: bound(F.lower(F.array_join(c, " ")), lambda j: F.struct(i.alias("row_no"), c.alias("cells"), only_th.alias("head"), (j.rlike("|".join(HEADER_WORDS)) & ~j.rlike(ANY_DATE)).alias("hint"))))

    # a table's rows stay one value, so headers are carried on without a shuffle
    rows = tables.select(doc_id, "table_no", F.filter(F.transform(F.regexp_extract_all("__t", F.lit(row), 1), read), lambda r: F.size(r["cells"]) > 0).alias("__rows"))
    headed = rows.withColumn("__heads", F.filter("__rows", lambda r: r["head"]))
    first = F.get("__heads", F.lit(0))["row_no"]
    guessed = headed.withColumn("__guess", F.get(F.filter("__rows", lambda r: r["hint"] & (first.isNull() | (r["row_no"] < first))), F.lit(0)))
    # outer, as the planner would add a filter on the array's size to a plain one and work the array out for it once more
    each = guessed.select(doc_id, "table_no", "__heads", "__guess", F.explode_outer("__rows").alias("__r"))
    above = F.try_element_at(F.filter("__heads", lambda h: h["row_no"] <= F.col("__r.row_no")), F.lit(-1))["cells"]
    guess = F.when(F.col("__guess.row_no") <= F.col("__r.row_no"), F.col("__guess.cells"))
    named = each.select(doc_id, "table_no", F.col("__r.row_no").alias("row_no"), F.transform(F.coalesce(above, guess), lambda c: F.lower(c)).alias("headers"), F.col("__r.cells").alias("cells"), above.isNull().alias("__free"), "__r")
    again = F.col("__free") & F.col("__r.hint") & (F.transform("cells", lambda c: F.lower(c)) == F.col("headers"))
    return named.filter(F.col("headers").isNotNull() & ~F.col("__r.head") & ~again).select(doc_id, "table_no", "row_no", "headers", "cells")


def text_rows(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, line_no, headers, cells) of schedules in plain text.

    A line that names at least two kinds of dates and holds none heads the lines after it; a line under it with as many
    dates, and an amount with decimals or a dollar sign besides, is a row: its dates, then the amount.
    """
    def read(line: Column, i: Column) -> Column:
        return F.struct(i.alias("line_no"), line.alias("line"), find_dates(line).alias("dates"), header_kinds(line).alias("kinds"))

    # a document's lines stay one value, so headers are carried on without a shuffle
    lines = df.select(F.col(doc_id), F.filter(F.transform(F.split(text, r"\r?\n"), read), lambda r: F.trim(r["line"]) != "").alias("__lines"))
    headed = lines.withColumn("__heads", F.filter("__lines", lambda r: (F.size(r["kinds"]) >= 2) & (F.size(r["dates"]) == 0)))
    each = headed.select(doc_id, "__heads", F.explode_outer("__lines").alias("__r"))
    kinds = F.try_element_at(F.filter("__heads", lambda h: h["line_no"] < F.col("__r.line_no")), F.lit(-1))["kinds"]
    rows = each.withColumn("__kinds", kinds).filter((F.size("__r.dates") > 0) & (F.size("__r.dates") == F.size("__kinds")))
    rows = rows.withColumn("__a", F.regexp_extract(F.regexp_replace("__r.line", ANY_DATE, " "), r"(\$?\d*\.\d+|\$\d+)", 1)).filter(F.col("__a") != "")
    headers = F.concat(F.transform("__kinds", lambda k: F.when(k == "ex", "ex-date").otherwise(F.concat(k, F.lit(" date")))), F.array(F.lit("amount")))
    return rows.select(doc_id, F.col("__r.line_no").alias("line_no"), headers.alias("headers"), F.concat(F.transform("__r.dates", lambda d: d.cast("string")), F.array("__a")).alias("cells"))


# Words in the header of a column with the amount paid.
GROSS_WORDS = ("amount", "distribution", "dividend", "per unit", "per share", "cash", "total", "rate")


def rows_to_payouts(rows: DataFrame, keys: list[str], symbols: tuple[str, ...] = ()) -> DataFrame:
    """(keys, ex_date, record_date, payable_date, declaration_date, amount) of rows of any table, found by their headers.

    The first column of each kind of date counts; the amount is the total column's or else the first amount column's.
    Rows whose headers and cells differ in number, or that lack an ex-date or amount, are left out; so are, with
    ``symbols``, rows whose ticker column holds another symbol.
    """
    pairs = rows.filter(F.size("headers") == F.size("cells")).withColumn("__c", F.transform(F.arrays_zip("headers", "cells"), lambda p: F.struct(date_kind(p["headers"]).alias("kind"), p["headers"].alias("head"), p["cells"].alias("cell"))))

    def first(test) -> Column:
        return F.get(F.filter("__c", test), F.lit(0))["cell"]

    if symbols:
        ticker = F.upper(F.trim(first(lambda p: p["head"].rlike("ticker|symbol|fund code"))))
        pairs = pairs.filter(ticker.isNull() | (ticker == "") | ticker.isin([s.upper() for s in symbols]))
    total = first(lambda p: p["kind"].isNull() & F.contains(p["head"], F.lit("total")))
    other = first(lambda p: p["kind"].isNull() & p["head"].rlike("|".join(GROSS_WORDS)))
    number = F.regexp_replace(F.coalesce(total, other), r"[$,\s]|US|CA", "").try_cast("double")

    def dated(kind: str) -> Column:
        return F.get(find_dates(first(lambda p: p["kind"] == kind)), F.lit(0))

    dates = {f"{k}_date": dated(k) for k in ("ex", "record", "payable", "declaration")}
    # a generator, as a filter would be pushed below and read each date a second time
    found = F.array(F.struct(*(d.alias(n) for n, d in dates.items()), number.alias("amount")))
    return pairs.select(*keys, F.inline(F.filter(found, lambda r: r["ex_date"].isNotNull() & r["amount"].isNotNull())))


def index_rows(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, line_no, form, company, filer, filed, path) of a filing index: lines after the dashes, columns two blanks apart.

    The first column is the form, the last three are the filer's number, the day and the path; what is between is the
    company, whose own blanks become two where they are more. Lines that lack a column, or whose number or day is none,
    are left out, as are those that begin with a blank.
    """
    rows = df.select(F.col(doc_id).alias("__doc"), F.split(text, r"\r?\n").alias("__lines"))
    begun = F.array_position(F.transform("__lines", lambda x: F.startswith(x, F.lit("-----"))), True).cast("int")
    lines = rows.withColumn("__from", begun).filter("__from > 0").select("__doc", "__from", F.posexplode(F.slice("__lines", F.col("__from") + 1, F.size("__lines"))).alias("__no", "__l"))
    parts = lines.withColumn("__c", F.split(F.rtrim("__l"), r"\s{2,}")).filter(F.size("__c") >= 5)
    last = lambda i: F.element_at("__c", -i)
    day = F.replace(last(2), F.lit("-"), F.lit(""))
    shaped = last(2).rlike(r"^\d{8}$|^\d{4}-\d\d-\d\d$")
    read = parts.select(
        F.col("__doc").alias(doc_id), (F.col("__from") + F.col("__no")).alias("line_no"), F.get("__c", F.lit(0)).alias("form"), F.array_join(F.slice("__c", 2, F.size("__c") - 4), "  ").alias("company"),
        F.when(last(3).rlike(r"^\d{1,10}$"), bare_id(last(3))).alias("filer"), F.when(shaped, F.to_date(F.try_to_timestamp(day, F.lit("yyyyMMdd")))).alias("filed"), last(1).alias("path"),
    )
    return read.filter("form <> '' AND filer IS NOT NULL AND filed IS NOT NULL AND NOT path LIKE '% %'")


def zipped(arrays: dict[str, Column]) -> Column:
    """Parallel arrays as an array of structs, as long as the shortest."""
    shortest = F.least(*(F.size(a) for a in arrays.values())) if len(arrays) > 1 else F.size(next(iter(arrays.values())))
    return F.arrays_zip(*(F.slice(a, F.lit(1), F.greatest(shortest, F.lit(0))).alias(n) for n, a in arrays.items()))


def feed_rows(shredded: DataFrame) -> DataFrame:
    """(root_id, row_id, headers, cells) of all records that stand in lists anywhere in JSON documents; see shred_json."""
    entries = F.map_entries("cols")
    return shredded.filter((F.col("tab") != "$") & is_object()).select("root_id", "row_id", F.transform(entries, lambda e: spaced_key(e["key"])).alias("headers"), F.transform(entries, lambda e: F.coalesce(e["value"], F.lit(""))).alias("cells"))


_SHEET = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"


def _texts(item: ElementTree.Element) -> str:
    return "".join(t.text or "" for t in item.iter(f"{_SHEET}t"))


def _elements(file: IO[bytes], name: str) -> Iterator[ElementTree.Element]:
    """Each closed element of this name; what was read is let go."""
    steps = ElementTree.iterparse(file, events=("start", "end"))
    _, root = next(steps)
    for event, element in steps:
        if event == "end" and element.tag == name:
            yield element
            root.clear()


def sheet_cells(content: bytes) -> Iterator[tuple[str, int, list[str]]]:
    """(sheet file, row from 0, cells as text) of a workbook; nothing if it is none. Only the standard library is needed.

    A sheet that breaks off gives the rows before; a cell that names a shared text there isn't is empty.
    """
    try:
        book = zipfile.ZipFile(io.BytesIO(content))
    except (zipfile.BadZipFile, ValueError):
        return
    shared: list[str] = []
    try:
        if "xl/sharedStrings.xml" in book.namelist():
            with book.open("xl/sharedStrings.xml") as file:
                shared.extend(_texts(item) for item in _elements(file, f"{_SHEET}si"))
    except _BROKEN:
        pass
    for name in sorted(n for n in book.namelist() if re.fullmatch(r"xl/worksheets/[^/]+\.xml", n)):
        try:
            with book.open(name) as file:
                for i, row in enumerate(_elements(file, f"{_SHEET}row")):
                    yield name, i, _cells(row, shared)
        except _BROKEN:
            continue


_BROKEN = (ElementTree.ParseError, zipfile.BadZipFile, zlib.error, EOFError, KeyError, NotImplementedError, RuntimeError, StopIteration)


def _cells(row: ElementTree.Element, shared: list[str]) -> list[str]:
    cells: list[str] = []
    for cell in row.iter(f"{_SHEET}c"):
        place = 0
        for ch in re.sub(r"[^A-Za-z]", "", cell.get("r", ""))[:3]:
            place = place * 26 + ord(ch.upper()) - 64
        while place and len(cells) < place - 1:
            cells.append("")
        value = cell.find(f"{_SHEET}v")
        text = "" if value is None else value.text or ""
        inline = cell.find(f"{_SHEET}is")
        if cell.get("t") == "s":
            text = shared[int(text)] if text.isdecimal() and int(text) < len(shared) else ""
        elif inline is not None:
            text = _texts(inline)
        cells.append(text)
    return cells


def workbook_rows(df: DataFrame, doc_id: str, content: str) -> DataFrame:
    """(doc_id, sheet, row_no, headers, cells) of all sheets of workbooks given as bytes; the first row with a header's words and no date heads the rows after it."""
    any_date = re.compile(ANY_DATE)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for d, c in zip(batch["d"], batch["c"]):
                out: list[tuple] = []
                sheet, headers = None, None
                for name, i, cells in sheet_cells(c) if c is not None else ():
                    if name != sheet:
                        sheet, headers = name, None
                    joined = " ".join(cells).lower()
                    if headers is not None:
                        out.append((d, name, i, headers, cells))
                    elif re.search("ex-|ex date|record|pay", joined) and not any_date.search(joined):
                        headers = [h.strip().lower() for h in cells]
                    if len(out) >= 10_000:
                        yield pd.DataFrame(out, columns=["d", "sheet", "row_no", "headers", "cells"])
                        out = []
                yield pd.DataFrame(out, columns=["d", "sheet", "row_no", "headers", "cells"])

    kind = df.schema[doc_id].dataType.simpleString()
    rows = df.select(F.col(doc_id).alias("d"), F.col(content).alias("c")).mapInPandas(read, f"d {kind}, sheet string, row_no int, headers array<string>, cells array<string>")
    return rows.withColumnRenamed("d", doc_id)


def gross_of(columns: list[str]) -> Column:
    """The sum of amount cells with dollar signs and commas; what is no number counts as 0."""
    out = plain_amount(F.col(columns[0]))
    for c in columns[1:]:
        out = out + plain_amount(F.col(c))
    return out


__all__ = ["date_of", "feed_rows", "gross_of", "html_rows", "index_rows", "rows_to_payouts", "sheet_cells", "text_rows", "workbook_rows", "zipped"]
