"""Workbooks (.xlsx) as tables of cells.

Spark reads the files, one task parses one sheet of one file as a stream of
rows.  A sheet has at most a million rows by its format, so a task is bounded;
many workbooks are many tasks.
"""

from __future__ import annotations

import io
import posixpath
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the file format.
MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
RELATION = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
PACKAGE = "{http://schemas.openxmlformats.org/package/2006/relationships}"

CELLS = "file string, sheet string, row int, cells array<string>"
BATCH = 10_000


def column_number(reference: str) -> int:
    """The place of a cell in its row, from 0: `A1` is 0, `AA7` is 26."""
    number = 0
    for c in reference:
        if not c.isalpha():
            break
        number = number * 26 + ord(c.upper()) - ord("A") + 1
    return number - 1


def number_text(value: str) -> str:
    """A number as a sheet shows it: whole numbers without a fraction."""
    number = float(value)
    return str(int(number)) if number.is_integer() else repr(number)


def _text(element: ElementTree.Element) -> str:
    """The text of a string item; phonetic guides are none of it."""
    plain = [t.text or "" for t in element.findall(f"{MAIN}t")]
    rich = [t.text or "" for run in element.findall(f"{MAIN}r") for t in run.findall(f"{MAIN}t")]
    return "".join(plain + rich)


def _shared(book: zipfile.ZipFile) -> list[str]:
    """The texts that cells refer to by number."""
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    found = []
    with book.open("xl/sharedStrings.xml") as part:
        for _, element in ElementTree.iterparse(part):
            if element.tag == f"{MAIN}si":
                found.append(_text(element))
                element.clear()
    return found


def _parts(book: zipfile.ZipFile) -> dict[str, str]:
    """The part of the file that holds each sheet, by the sheet's name."""
    links = ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))
    targets = {r.get("Id"): r.get("Target") for r in links.findall(f"{PACKAGE}Relationship")}
    sheets = ElementTree.fromstring(book.read("xl/workbook.xml")).find(f"{MAIN}sheets")
    return {
        s.get("name"): posixpath.normpath(posixpath.join("/xl", targets[s.get(RELATION)])).lstrip("/")
        for s in (sheets if sheets is not None else ())
    }


def _value(cell: ElementTree.Element, shared: list[str]) -> str | None:
    kind, value = cell.get("t", "n"), cell.find(f"{MAIN}v")
    if kind == "inlineStr":
        inline = cell.find(f"{MAIN}is")
        return None if inline is None else _text(inline)
    if value is None or value.text is None or kind == "e":
        return None
    if kind == "s":
        return shared[int(value.text)]
    if kind == "b":
        return "true" if value.text.strip() == "1" else "false"
    return number_text(value.text) if kind == "n" else value.text


def sheet_rows(content: bytes, sheet: str) -> Iterator[tuple[int, list[str | None]]]:
    """Number, from 1, and cells of the rows of a sheet that hold any value; none where there is no such sheet."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        part = _parts(book).get(sheet)
        if part is None:
            return
        shared = _shared(book)
        with book.open(part) as xml:
            number = 0
            for _, element in ElementTree.iterparse(xml):
                if element.tag != f"{MAIN}row":
                    continue
                number = int(element.get("r", number + 1))
                cells: list[str | None] = []
                for cell in element.findall(f"{MAIN}c"):
                    place = column_number(cell.get("r", "")) if cell.get("r") else len(cells)
                    cells += [None] * (place + 1 - len(cells))
                    cells[place] = _value(cell, shared)
                element.clear()
                if any(c is not None for c in cells):
                    yield number, cells


def scan_workbook(spark: SparkSession, path: str, sheets: list[str]) -> DataFrame:
    """The named sheets of the workbooks at a path: file, sheet, row number and the cells as texts.

    Numbers are texts of the numbers, truth values `true` or `false`; empty cells and errors are null;
    rows without any value are left out.  Files are read whole, up to the 2 GB of a binary value.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    each = files.withColumn("sheet", F.explode(F.array(*[F.lit(s) for s in sheets])))
    each = each.repartition("path", "sheet").select("path", "sheet", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(file: str, sheet: str, held: list[tuple[int, list[str | None]]]) -> pa.RecordBatch:
            columns = [
                pa.array([file] * len(held), pa.string()),
                pa.array([sheet] * len(held), pa.string()),
                pa.array([n for n, _ in held], pa.int32()),
                pa.array([cells for _, cells in held], pa.list_(pa.string())),
            ]
            return pa.RecordBatch.from_arrays(columns, names=["file", "sheet", "row", "cells"])

        for part in batches:
            for file, sheet, content in zip(*part.columns, strict=True):
                held = []
                for row in sheet_rows(content.as_py(), sheet.as_py()):
                    held.append(row)
                    if len(held) == BATCH:
                        yield batch(file.as_py(), sheet.as_py(), held)
                        held = []
                if held:
                    yield batch(file.as_py(), sheet.as_py(), held)

    return each.mapInArrow(run, CELLS)
