"""Excel workbook scan (S10): ``.xlsx`` / ``.xlsm`` files -> one row per sheet row.

A workbook is a zip archive and cannot be split, so the unit of work is one file:
``binaryFile`` lists the files (Spark packs small ones into a task) and
``mapInPandas`` parses each workbook with the standard library (zipfile + XML),
emitting ``(path, sheet, row_no, cells)`` as Arrow batches. Everything after the
parse (header pick, lineage, typing) is DataFrame code. Date-formatted cells
become ISO text, as the all-text bronze layer wants.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator, Sequence
from datetime import datetime, timedelta
from xml.etree import ElementTree as ET

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main",
       "r": "http://schemas.openxmlformats.org/officeDocument/2006/relationships",
       "rel": "http://schemas.openxmlformats.org/package/2006/relationships"}
# Built-in number formats that display dates / times.
_DATE_FORMAT_IDS = {14, 15, 16, 17, 18, 19, 20, 21, 22, 45, 46, 47}
_SCHEMA = "path string, sheet string, row_no int, ordinal int, cells array<string>, names array<string>, error string"


def _col_index(ref: str) -> int:
    letters = re.match(r"[A-Z]+", ref).group(0)
    n = 0
    for ch in letters:
        n = n * 26 + (ord(ch) - 64)
    return n - 1


def _date_styles(z: zipfile.ZipFile) -> set[int]:
    if "xl/styles.xml" not in z.namelist():
        return set()
    root = ET.fromstring(z.read("xl/styles.xml"))
    custom = {}
    for nf in root.findall("m:numFmts/m:numFmt", _NS):
        code = re.sub(r'"[^"]*"|\[[^\]]*\]', "", nf.get("formatCode", "")).lower()
        custom[int(nf.get("numFmtId"))] = bool(re.search(r"[dmyhs]", code))
    out = set()
    for i, xf in enumerate(root.findall("m:cellXfs/m:xf", _NS)):
        fid = int(xf.get("numFmtId", "0"))
        if fid in _DATE_FORMAT_IDS or custom.get(fid, False):
            out.add(i)
    return out


def _excel_date(serial: float, date1904: bool) -> str:
    base = datetime(1904, 1, 1) if date1904 else datetime(1899, 12, 30)
    d = base + timedelta(days=serial)
    return d.strftime("%Y-%m-%d %H:%M:%S") if d.time() != datetime.min.time() else d.strftime("%Y-%m-%d 00:00:00")


def parse_workbook(content: bytes) -> Iterator[tuple[str, int, int, list]]:
    """Yield ``(sheet, row_no, ordinal, cells)`` for every non-empty row of every sheet;
    ``ordinal`` counts non-empty rows from 0 (pandas' header / index positions)."""
    z = zipfile.ZipFile(io.BytesIO(content))
    wb = ET.fromstring(z.read("xl/workbook.xml"))
    pr = wb.find("m:workbookPr", _NS)
    date1904 = pr is not None and pr.get("date1904") in ("1", "true")
    rels = ET.fromstring(z.read("xl/_rels/workbook.xml.rels"))
    targets = {r.get("Id"): r.get("Target") for r in rels.findall("rel:Relationship", _NS)}
    shared: list[str] = []
    if "xl/sharedStrings.xml" in z.namelist():
        for si in ET.fromstring(z.read("xl/sharedStrings.xml")).findall("m:si", _NS):
            shared.append("".join(t.text or "" for t in si.iter(f"{{{_NS['m']}}}t")))
    dates = _date_styles(z)
    for sh in wb.findall("m:sheets/m:sheet", _NS):
        target = targets[sh.get(f"{{{_NS['r']}}}id")].lstrip("/")
        part = target if target.startswith("xl/") else f"xl/{target}"
        root = ET.fromstring(z.read(part))
        ordinal = 0
        for row in root.findall("m:sheetData/m:row", _NS):
            cells: dict[int, str | None] = {}
            for c in row.findall("m:c", _NS):
                t, v = c.get("t"), c.find("m:v", _NS)
                if t == "s" and v is not None:
                    val = shared[int(v.text)]
                elif t == "inlineStr":
                    val = "".join(x.text or "" for x in c.iter(f"{{{_NS['m']}}}t"))
                elif t == "b" and v is not None:
                    val = "True" if v.text == "1" else "False"
                elif v is not None and v.text is not None:
                    val = v.text
                    if t in (None, "n") and int(c.get("s", "0")) in dates:
                        val = _excel_date(float(val), date1904)
                else:
                    val = None
                cells[_col_index(c.get("r"))] = val
            if any(x not in (None, "") for x in cells.values()):
                width = max(cells) + 1
                yield sh.get("name"), int(row.get("r")), ordinal, [cells.get(i) for i in range(width)]
                ordinal += 1


CHUNK_ROWS = 1000  # rows of a workbook that leave the parser at once


def _parser(header: int | None):
    """Rows of workbooks, chunk by chunk, each with its sheet's header row (``names``). A file
    that cannot be read gives one row with ``error``."""
    columns = ["path", "sheet", "row_no", "ordinal", "cells", "names", "error"]

    def rows(path: str, content: bytes) -> Iterator[tuple]:
        at, names = None, None
        try:
            for sheet, rn, ordinal, cells in parse_workbook(content):
                if sheet != at:
                    at, names = sheet, None
                if ordinal == header:
                    names = cells
                yield path, sheet, rn, ordinal, cells, names, None
        except (zipfile.BadZipFile, ET.ParseError, KeyError, AttributeError, ValueError, IndexError) as e:
            yield path, None, None, None, None, None, f"{type(e).__name__}: {e}"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path, content in zip(pdf["path"], pdf["content"]):
                out: list[tuple] = []
                for row in rows(path, bytes(content)):
                    out.append(row)
                    if len(out) == CHUNK_ROWS:
                        yield pd.DataFrame(out, columns=columns, dtype=object)
                        out = []
                if out:
                    yield pd.DataFrame(out, columns=columns, dtype=object)

    return run


def scan_workbooks(spark: SparkSession, paths: str | Sequence[str], header: int | None = None) -> DataFrame:
    """All rows of all sheets: ``(path, sheet, row_no, ordinal, cells, names, error)``. Every file
    is parsed once; ``names`` is the sheet's row number ``header`` on the rows from there on."""
    ps = [paths] if isinstance(paths, str) else list(paths)
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", "*.xls[xm]").load(ps).select("path", "content"))
    return files.mapInPandas(_parser(header), _SCHEMA)


def unreadable_workbooks(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``(path, error)`` of the files that were skipped."""
    return scan_workbooks(spark, paths).filter(F.col("error").isNotNull()).select("path", "error")


def read_workbook_with_lineage(spark: SparkSession, paths: str | Sequence[str], header: int = 0,
                               sheet_name: str | None = None, source_col: str = "Source") -> DataFrame:
    """S10 + S11: sheet rows below the header row become all-text records.

    ``header`` is the 0-based index of the header among the sheet's non-empty rows
    (as pandas counts). Column names come from each (file, sheet) header row, so the
    result is long: ``(source_file, sheet, row_no, column, value, Source, source_path, source_id)``. Use
    :func:`pivot_workbook` to widen one layout. Lineage: ``<stem>:<sheet>:row:<n>``, the stem with ``~``
    and part of the path's hash where files of one name meet. Files that cannot be read are skipped; :func:`unreadable_workbooks` lists them.
    """
    rows = scan_workbooks(spark, paths, header).filter(F.col("ordinal") > header)
    if sheet_name is not None:
        rows = rows.filter(F.col("sheet") == sheet_name)
    long = rows.select("path", "sheet", "row_no",
                       F.posexplode(F.arrays_zip(F.col("names").alias("n"), F.col("cells").alias("v"))).alias("_i", "_z"))
    long = long.join(_labels(spark, paths), "path")
    return long.select(
        F.element_at(F.split("path", "/"), -1).alias("source_file"), "sheet", "row_no",
        F.coalesce(F.col("_z.n"), F.concat(F.lit("Unnamed: "), F.col("_i").cast("string"))).alias("column"),
        F.col("_z.v").alias("value"),
        F.concat("_stem", F.lit(":"), F.col("sheet"), F.lit(":row:"), F.col("row_no").cast("string")).alias(source_col),
        F.col("path").alias("source_path"), F.substring(F.sha2(F.col("path"), 256), 1, 16).alias("source_id"))


def _labels(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``path, _stem``: a file's name in labels, with part of the path's hash where two files share the
    name. Read from the listing alone; no content is touched."""
    ps = [paths] if isinstance(paths, str) else list(paths)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.xls[xm]").load(ps).select("path")
    stem = F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"\.[^.]+$", "")
    known = files.withColumn("_stem", stem)
    same = known.groupBy("_stem").agg(F.count(F.lit(1)).alias("_same"))
    marked = F.concat("_stem", F.lit("~"), F.substring(F.sha2(F.col("path"), 256), 1, 8))
    return known.join(same, "_stem").select("path", F.when(F.col("_same") > 1, marked).otherwise(F.col("_stem")).alias("_stem"))


def pivot_workbook(long: DataFrame, columns: Sequence[str], source_col: str = "Source") -> DataFrame:
    """Widen one sheet layout: one all-text column per name in ``columns``."""
    return (long.groupBy("source_file", "source_path", "source_id", "sheet", "row_no", source_col)
            .pivot("column", list(columns)).agg(F.first("value")))
