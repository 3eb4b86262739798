"""Workbooks as rows: the first row of a sheet names its columns."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The names that a workbook's parts are written with.
MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
LINK = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
PARTS, TEXTS = "xl/_rels/workbook.xml.rels", "xl/sharedStrings.xml"
#: Rows of a sheet that are handed on at once.
HELD = 10_000


def sheet_files(book: zipfile.ZipFile) -> list[tuple[str, str]]:
    """(name, file) of the sheets of a workbook, in order."""
    to = {e.get("Id"): e.get("Target") for e in ElementTree.fromstring(book.read(PARTS))}
    named = [(e.get("name"), to.get(e.get(LINK), "")) for e in ElementTree.fromstring(book.read("xl/workbook.xml")).iter(f"{MAIN}sheet")]
    return [(n, t.lstrip("/") if t.startswith("/") else f"xl/{t}") for n, t in named]


def column_number(cell: str) -> int:
    """0 for A, 26 for AA."""
    n = 0
    for c in re.match("[A-Z]*", cell)[0]:
        n = n * 26 + ord(c) - 64
    return n - 1


def rows_of(book: zipfile.ZipFile, file: str) -> Iterator[tuple[int, dict[int, str]]]:
    """(number, cells by column) of the rows of a sheet that have any, one at a time."""
    shared = []
    if TEXTS in book.namelist():
        shared = ["".join(t.text or "" for t in e.iter(f"{MAIN}t")) for e in ElementTree.fromstring(book.read(TEXTS)).iter(f"{MAIN}si")]
    for _, row in ElementTree.iterparse(book.open(file)):
        if row.tag != f"{MAIN}row":
            continue
        cells = {}
        for k, c in enumerate(row.iter(f"{MAIN}c")):
            v = c.find(f"{MAIN}v")
            if c.get("t") == "inlineStr":
                value = "".join(t.text or "" for t in c.iter(f"{MAIN}t"))
            elif v is None or v.text is None:
                continue
            else:
                value = shared[int(v.text)] if c.get("t") == "s" else v.text
            cells[column_number(c.get("r", "")) if c.get("r") else k] = value
        if cells:
            yield int(row.get("r", "0")), cells
        row.clear()


def read_sheets(spark: SparkSession, path: str, columns: list[str], sheet: str | None = None) -> DataFrame:
    """path, sheet, row_number and the named columns as text of every sheet of the workbooks at path (or of those
    called `sheet`). Names are compared trimmed and without case; a sheet that lacks one gives null. Empty rows are
    passed over. Each sheet is a task; workbooks come through Spark's own reader, from any store."""

    def listed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for p, content in zip(pdf["path"], pdf["content"], strict=True):
                names = [(n, f) for n, f in sheet_files(zipfile.ZipFile(io.BytesIO(content))) if sheet is None or n == sheet]
                yield pd.DataFrame({"path": p, "sheet": [n for n, _ in names], "file": [f for _, f in names], "content": [content] * len(names)})

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for p, name, file, content in zip(*(pdf[c] for c in ("path", "sheet", "file", "content")), strict=True):
                rows = rows_of(zipfile.ZipFile(io.BytesIO(content)), file)
                _, header = next(rows, (0, {}))
                at = {v.strip().lower(): k for k, v in reversed(header.items())}
                held = []
                for number, cells in rows:
                    held.append((p, name, number, *[cells.get(at.get(c.strip().lower(), -1)) for c in columns]))
                    if len(held) == HELD:
                        yield pd.DataFrame(held, columns=out)
                        held = []
                if held:
                    yield pd.DataFrame(held, columns=out)

    out = ["path", "sheet", "row_number", *columns]
    kinds = "path string, sheet string, row_number int" + "".join(f", `{c}` string" for c in columns)
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    each = files.mapInPandas(listed, "path string, sheet string, file string, content binary")
    return each.repartition(F.col("path"), F.col("sheet")).mapInPandas(read, kinds)
