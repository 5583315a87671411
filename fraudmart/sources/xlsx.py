"""Workbook drop files (S5, S6): first sheet, header row, positional columns.

Spark's ``binaryFile`` source reads the workbooks from any Hadoop filesystem
(HDFS, object stores, local) and ``mapInPandas`` parses each one on an executor
with the standard library (an ``.xlsx`` file is a zip of XML parts), yielding
Arrow batches; many workbooks load in parallel and no file passes through the
driver.  A sheet holds at most 1,048,576 rows, which bounds the work per file.

Only what the feeds need is read: cell values of the first sheet.  Numbers in a
text column become their text (integers without ``.0``); numbers in a
timestamp column are spreadsheet date serials; text in a timestamp column is
parsed as ``yyyy-MM-dd[ HH:mm:ss]``.  Empty cells are NULL (H3).
"""

from __future__ import annotations

import datetime as _dt
import io
import posixpath
import re
import zipfile
from collections.abc import Iterator, Sequence
from xml.etree import ElementTree as ET

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from fraudmart.functions import empty_as_null, to_stamp_text

# Rows per Arrow batch handed back to Spark.
BATCH_ROWS = 10_000

_NS = {
    "m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main",
    "r": "http://schemas.openxmlformats.org/officeDocument/2006/relationships",
    "rel": "http://schemas.openxmlformats.org/package/2006/relationships",
}
_CELL_REF = re.compile(r"([A-Z]+)(\d+)")
# Day zero of spreadsheet date serials (1900 system, with its leap-year quirk
# absorbed by starting on 1899-12-30) and of the 1904 system.
_EPOCH_1900 = _dt.datetime(1899, 12, 30)
_EPOCH_1904 = _dt.datetime(1904, 1, 1)


def _column_index(letters: str) -> int:
    idx = 0
    for ch in letters:
        idx = idx * 26 + (ord(ch) - ord("A") + 1)
    return idx - 1


def _text_of(node: ET.Element) -> str:
    return "".join(t.text or "" for t in node.iter(f"{{{_NS['m']}}}t"))


def _first_sheet_path(zf: zipfile.ZipFile) -> tuple[str, bool]:
    wb = ET.fromstring(zf.read("xl/workbook.xml"))
    pr = wb.find("m:workbookPr", _NS)
    date1904 = pr is not None and pr.get("date1904") in ("1", "true")
    sheet = wb.find("m:sheets/m:sheet", _NS)
    if sheet is None:
        raise ValueError("workbook has no sheet")
    rid = sheet.get(f"{{{_NS['r']}}}id")
    rels = ET.fromstring(zf.read("xl/_rels/workbook.xml.rels"))
    for rel in rels.findall("rel:Relationship", _NS):
        if rel.get("Id") == rid:
            target = rel.get("Target")
            path = target.lstrip("/") if target.startswith("/") else posixpath.normpath(posixpath.join("xl", target))
            return path, date1904
    raise ValueError(f"workbook sheet relation {rid} not found")


def _shared_strings(zf: zipfile.ZipFile) -> list[str]:
    try:
        root = ET.fromstring(zf.read("xl/sharedStrings.xml"))
    except KeyError:
        return []
    return [_text_of(si) for si in root.findall("m:si", _NS)]


def _cell_value(cell: ET.Element, strings: list[str]) -> object:
    kind = cell.get("t", "n")
    v = cell.find("m:v", _NS)
    if kind == "s":
        return strings[int(v.text)] if v is not None else None
    if kind == "inlineStr":
        node = cell.find("m:is", _NS)
        return _text_of(node) if node is not None else None
    if kind in ("str", "e"):
        return v.text if v is not None else None
    if kind == "b":
        return (v.text == "1") if v is not None else None
    return float(v.text) if v is not None and v.text not in (None, "") else None


def iter_sheet_rows(workbook: str | bytes) -> Iterator[tuple[list[object], bool]]:
    """Raw cell values of the first sheet, row by row (header included).

    The sheet is parsed as a stream (``iterparse``) and each row is released and
    taken out of its parent once read.  A row number that the sheet leaves out is a
    blank row.
    """
    row_tag, data_tag = f"{{{_NS['m']}}}row", f"{{{_NS['m']}}}sheetData"
    source = io.BytesIO(workbook) if isinstance(workbook, (bytes, bytearray)) else workbook
    with zipfile.ZipFile(source) as zf:
        sheet_path, date1904 = _first_sheet_path(zf)
        strings = _shared_strings(zf)
        with zf.open(sheet_path) as stream:
            parent, number = None, 0
            for event, row in ET.iterparse(stream, events=("start", "end")):
                if event == "start":
                    parent = row if row.tag == data_tag else parent
                    continue
                if row.tag != row_tag:
                    continue
                last, number = number, int(row.get("r", number + 1))
                for _ in range(last + 1, number):
                    yield [], date1904
                values: dict[int, object] = {}
                for pos, cell in enumerate(row.findall("m:c", _NS)):
                    ref = cell.get("r")
                    col = _column_index(_CELL_REF.match(ref).group(1)) if ref else pos
                    values[col] = _cell_value(cell, strings)
                parent.clear()
                width = max(values) + 1 if values else 0
                yield [values.get(i) for i in range(width)], date1904


def _to_text(value: object) -> str | None:
    if value is None:
        return None
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, float):
        return str(int(value)) if value.is_integer() else repr(value)
    text = str(value)
    return text if text != "" else None


def _to_timestamp(value: object, date1904: bool) -> _dt.datetime | None:
    if value is None or value == "":
        return None
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        epoch = _EPOCH_1904 if date1904 else _EPOCH_1900
        stamp = epoch + _dt.timedelta(days=float(value))
        return (stamp + _dt.timedelta(microseconds=500_000)).replace(microsecond=0)
    return _dt.datetime.strptime(to_stamp_text(str(value)), "%Y-%m-%d %H:%M:%S")


def workbook_rows(content: bytes, kinds: list[str]) -> Iterator[tuple]:
    """Typed data rows of one workbook (header skipped, columns by position).

    A value beyond the expected columns is an error.  A blank row between others is
    a row of NULLs; blank rows at the end are not data.
    """
    width, blank = len(kinds), 0
    for i, (cells, date1904) in enumerate(iter_sheet_rows(content)):
        if i == 0:
            continue  # header row: names are ignored, columns bind by position
        if any(c not in (None, "") for c in cells[width:]):
            raise ValueError(f"row {i + 1} has more than {width} columns")
        cells = (cells + [None] * width)[:width]
        if all(c is None or c == "" for c in cells):
            blank += 1
            continue
        for _ in range(blank):
            yield (None,) * width
        blank = 0
        yield tuple(_to_timestamp(c, date1904) if k == "ts" else _to_text(c) for c, k in zip(cells, kinds))


def read_workbooks(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType) -> DataFrame:
    """Read the first sheet of each workbook with a positional schema."""
    import pandas as pd

    if isinstance(paths, str):
        paths = [paths]
    names = [f.name for f in schema.fields]
    kinds = ["ts" if isinstance(f.dataType, (T.TimestampNTZType, T.TimestampType)) else "text" for f in schema.fields]

    def parse(batches):
        for files in batches:
            for content in files["content"]:
                chunk = []
                for row in workbook_rows(bytes(content), kinds):
                    chunk.append(row)
                    if len(chunk) >= BATCH_ROWS:
                        yield pd.DataFrame(chunk, columns=names, dtype=object)
                        chunk = []
                if chunk:
                    yield pd.DataFrame(chunk, columns=names, dtype=object)

    files = spark.read.format("binaryFile").load(list(paths)).select("content")
    df = files.mapInPandas(parse, schema)
    return df.select(
        *[
            empty_as_null(f.name).alias(f.name) if isinstance(f.dataType, T.StringType) else f.name
            for f in schema.fields
        ]
    )


TERMINALS_FILE_SCHEMA = T.StructType(
    [
        T.StructField("terminal_id", T.StringType(), True),
        T.StructField("terminal_type", T.StringType(), True),
        T.StructField("terminal_city", T.StringType(), True),
        T.StructField("terminal_address", T.StringType(), True),
    ]
)

BLACKLIST_FILE_SCHEMA = T.StructType(
    [
        T.StructField("entry_dt", T.TimestampNTZType(), True),
        T.StructField("passport_num", T.StringType(), True),
    ]
)


def read_terminals(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Id, type, city, address."""
    return read_workbooks(spark, paths, TERMINALS_FILE_SCHEMA)


def read_blacklist(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Entry date, passport number (file order)."""
    return read_workbooks(spark, paths, BLACKLIST_FILE_SCHEMA)
