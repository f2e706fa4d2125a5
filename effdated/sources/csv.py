"""CSV / TXT ingest into all-text bronze rows with row lineage.

Every file is read with its own header, after its own preamble, and no raw line is shuffled:

1. files are scanned as text lines. ``monotonically_increasing_id()`` numbers the lines of
   a scan split consecutively, and a written table with one row per split ``(file, block)`` turns
   that into physical line numbers without a window over a file;
2. the first ``skiprows`` physical lines of a file go (blank ones count), then blank lines; of
   what is left, line number ``header`` names the file's columns. One row per file is written;
3. one pass parses the lines of all layouts into arrays, and each column of the result is taken from
   the place where the file's header has it (an array of the per-split table, which is broadcast):
   the work does not depend on the number of layouts;
4. lines with more fields than the header are dropped, as pandas drops bad lines. The rest
   are numbered by a second consecutive id and the counts per split of the rows left.

That makes four scans (splits, headers, counts, result), whatever the number of files and
layouts. Distinct header lines are collected while the plan is built: bounded by the layouts.

The label is ``<stem>:row:<record number>``, which equals pandas' ``index + 2 + skiprows +
header``. Files with quoted line feeds (``multiline``) cannot be split: they go through the CSV
parser, numbered in parsed records before any is dropped; their preamble and header are
lines without quoted line feeds.
"""

from __future__ import annotations

import csv as _csv
import io
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from effdated.operators.scan import stored

# pandas' default tokens read as missing.
NA_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
             "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]

OVERFLOW = "_overflow"


def _names(line: str, sep: str) -> list[str]:
    """Column names of a header line: blank ones numbered, repeated ones told apart as pandas does."""
    row = next(_csv.reader(io.StringIO(line), delimiter=sep))
    names, seen = [], {}
    for i, n in enumerate(row):
        n = n.strip() or f"Unnamed: {i}"
        k = seen.get(n, 0)
        seen[n] = k + 1
        names.append(n if k == 0 else f"{n}.{k}")
    return names


#: Splits (and files) of one load at most: the per-split table is broadcast, which keeps raw lines in
#: their tasks. 2 million splits of 128 MB are 256 TB; larger loads go folder by folder.
MAX_SPLITS = 2_000_000


def _placed(raw: DataFrame) -> DataFrame:
    """A fresh scan with its place: ``_file``, split ``_blk`` and ``_mid``, consecutive within a split."""
    return raw.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_blk"),
                      F.monotonically_increasing_id().alias("_mid"))


def _split_table(rows: DataFrame, mid: str, off: str, m0: str) -> DataFrame:
    """Per split of ``rows``: its first ``mid`` (``m0``) and the rows of the file's earlier splits
    (``off``). Counted with partial aggregation: only one row per split leaves a task."""
    counts = rows.groupBy("_file", "_blk").agg(F.count(F.lit(1)).alias("_n"), F.min(mid).alias(m0))
    w = Window.partitionBy("_file").orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select("_file", "_blk", m0, F.coalesce(F.sum("_n").over(w), F.lit(0)).alias(off))


def _recorded(placed: DataFrame, splits: DataFrame) -> DataFrame:
    """Add ``_record``, the 1-based number of a line (or parsed record) within its file."""
    return placed.join(F.broadcast(splits), ["_file", "_blk"]).withColumn("_record", (F.col("_off") + F.col("_mid") - F.col("_m0") + 1).cast("long"))


def _text_scan(spark: SparkSession, paths: Sequence[str], encoding: str) -> DataFrame:
    raw = spark.read.option("recursiveFileLookup", "true").text(list(paths))
    if encoding.lower().replace("-", "") != "utf8":
        raw = raw.withColumn("value", F.decode(F.col("value").cast("binary"), encoding))
    return raw


def _checked_splits(placed: DataFrame, label: str) -> DataFrame:
    splits = stored(_split_table(placed, "_mid", "_off", "_m0"), label)
    if splits.count() > MAX_SPLITS:
        raise ValueError(f"more than {MAX_SPLITS} splits in one load; load folder by folder")
    return splits


def _headers(lines: DataFrame, skiprows: int, header: int) -> DataFrame:
    """``_file, _at, _line, _valid`` per file: place and text of its header line, and whether all lines
    are valid text. One row per file, by partial aggregation. ``header < 0``: no header line."""
    text = lines.withColumn("_ok", (F.col("_record") > skiprows) & (F.trim("value") != ""))
    first = F.min(F.when(F.col("_ok"), F.struct(F.col("_record").alias("at"), F.col("value").alias("line"))))
    found = text.groupBy("_file").agg(first.alias("_h"), F.min(F.expr("is_valid_utf8(value)")).alias("_valid"))
    if header < 0:
        return found.select("_file", F.lit(skiprows).cast("long").alias("_at"), F.lit("").alias("_line"), "_valid")
    for _ in range(header):
        seen = F.broadcast(found.select("_file", F.col("_h.at").alias("_seen"), "_valid"))
        after = text.join(seen, "_file").withColumn("_ok", F.col("_ok") & (F.col("_record") > F.col("_seen")))
        found = after.groupBy("_file").agg(first.alias("_h"), F.first("_valid").alias("_valid"))
    return found.select("_file", F.col("_h.at").alias("_at"), F.col("_h.line").alias("_line"), "_valid")


def _file_table(spark: SparkSession, paths: Sequence[str], skiprows: int, header: int, encoding: str) -> tuple[DataFrame, DataFrame]:
    """``(lines, files)``: the numbered text lines, and one written row per file (see ``_headers``)."""
    placed = _placed(_text_scan(spark, paths, encoding))
    lines = _recorded(placed, _checked_splits(placed, "csv-splits"))
    return lines, stored(_headers(lines, skiprows, header), "csv-files")


def read_header(spark: SparkSession, paths: Sequence[str], sep: str = ",", skiprows: int = 0,
                header: int = 0, encoding: str = "utf-8") -> list[str]:
    """Column names when all files share one header line; raises when they differ."""
    _, files = _file_table(spark, paths, skiprows, header, encoding)
    lines = [r["_line"] for r in files.filter("_line is not null").select("_line").distinct().collect()]
    if not lines:
        raise ValueError(f"no header line under {list(paths)}")
    if len(lines) > 1:
        raise ValueError(f"files have {len(lines)} different headers")
    return _names(lines[0], sep)


def csv_faults(spark: SparkSession, paths: str | Sequence[str], skiprows: int = 0, header: int = 0, encoding: str = "utf-8") -> DataFrame:
    """``(path, error)`` of the files that :func:`read_csv_with_lineage` skips: those without a header
    line (empty ones too) and those that are no valid text."""
    ps = [paths] if isinstance(paths, str) else list(paths)
    _, files = _file_table(spark, ps, skiprows, header, encoding)
    listed = spark.read.option("recursiveFileLookup", "true").text(ps).inputFiles()  # the scan's own listing; empty files never reach a task
    every = spark.createDataFrame([(f,) for f in listed], "path string")
    bare = lambda c: F.regexp_replace(c, "^([a-z0-9]+:)/+", "$1/")  # noqa: E731  file:/ and file:///
    known = every.join(files, bare("path") == bare("_file"), "left")
    error = (F.when(F.col("_line").isNull(), f"no header line after {skiprows} lines").when(~F.col("_valid"), f"not valid {encoding}"))
    return known.select("path", error.alias("error")).filter("error is not null")


def read_csv_with_lineage(spark: SparkSession, paths: str | Sequence[str], sep: str = ",",
                          skiprows: int = 0, header: int = 0, multiline: bool = False,
                          encoding: str = "utf-8", na_tokens: Sequence[str] = NA_TOKENS,
                          names: Sequence[str] | None = None, keep_broken: bool = False,
                          source_col: str = "Source") -> DataFrame:
    """All-text bronze rows + ``Source`` lineage, ``source_file``, ``source_path``,
    ``source_id`` (a short hash of the path, unlike the file name unique) and ``record_no``.

    Columns are those of the files' headers (``names`` overrides them, by position); a
    column that a file lacks is null. Too-long rows are dropped (``keep_broken=True`` keeps
    them with ``_overflow`` set and no record number), short rows are null-padded, NA tokens
    become null. ``header=-1`` (with ``names``): files without a header line. Files
    that are no valid text or have no header line are skipped; :func:`csv_faults` lists them.
    Labels are unique in a load: files of one name in two folders get ``~`` and the first
    eight digits of their ``source_id`` behind the name.
    """
    ps = [paths] if isinstance(paths, str) else list(paths)
    if header < 0 and not names:
        raise ValueError("files without a header line need names")
    lines, files = _file_table(spark, ps, skiprows, header, encoding)
    usable = files.filter("_line is not null and _valid")
    layouts = sorted(r["_line"] for r in usable.select("_line").distinct().collect())  # one per distinct header
    if not layouts:
        raise ValueError(f"no header line under {ps}")
    named = {line: list(names) if names else _names(line, sep) for line in layouts}
    columns = list(dict.fromkeys(c for line in layouts for c in named[line]))
    widest = max(map(len, named.values()))
    fields = [f"_c{i}" for i in range(widest + 1)]
    if multiline:
        # records before the data: the lines up to the header that the parser does not skip as empty
        before = (lines.join(F.broadcast(usable.select("_file", "_at")), "_file").filter((F.col("_record") <= F.col("_at")) & (F.col("value") != ""))
                  .groupBy("_file").agg(F.count(F.lit(1)).alias("_records")))
        usable = usable.join(before, "_file", "left").withColumn("_at", F.coalesce("_records", F.lit(0))).drop("_records")
        raw = (spark.read.schema(", ".join(f"{c} string" for c in fields)).option("header", "false").option("sep", sep).option("mode", "PERMISSIVE")
               .option("multiLine", "true").option("encoding", encoding).option("recursiveFileLookup", "true").csv(ps))
        parsed = _placed(raw).withColumn("_vals", F.array(*fields)).drop(*fields)
        splits, blank = _checked_splits(parsed, "csv-records"), F.lit(False)
    else:
        parsed = _placed(_text_scan(spark, ps, encoding).withColumn("_p", F.from_csv("value", F.lit(", ".join(f"{c} string" for c in fields)), {"sep": sep, "mode": "PERMISSIVE"})))
        parsed = parsed.withColumn("_vals", F.array(*[F.col(f"_p.{c}") for c in fields])).drop("_p")
        splits, blank = lines.select("_file", "_blk", "_m0", "_off").distinct(), F.trim("value") == ""
    width = {line: len(named[line]) for line in layouts}
    place = {line: [named[line].index(c) if c in named[line] else -1 for c in columns] for line in layouts}
    shapes = spark.createDataFrame([(line, width[line], place[line]) for line in layouts], "_line string, _width int, _place array<int>")
    places = stored(splits.join(_labelled(usable).join(F.broadcast(shapes), "_line"), "_file").drop("_line", "_valid"), "csv-places")
    data = _recorded(parsed, places).filter((F.col("_record") > F.col("_at")) & ~blank)
    over = F.get("_vals", F.col("_width"))
    good = data.filter(over.isNull()).withColumn("_good", F.monotonically_increasing_id())
    numbers = _split_table(good, "_good", "_off2", "_g0")
    good = good.join(F.broadcast(numbers), ["_file", "_blk"])
    first = skiprows + header + 2
    good = good.withColumn("_record", (F.col("_off2") + F.col("_good") - F.col("_g0") + first).cast("long"))
    out = _bronze(good, columns, na_tokens, source_col, keep_broken, F.lit(None).cast("string"))
    if keep_broken:
        bad = data.filter(over.isNotNull()).withColumn("_record", F.lit(None).cast("long"))
        out = out.unionByName(_bronze(bad, columns, (), source_col, True, F.get("_vals", F.col("_width"))))
    return out


def _labelled(files: DataFrame) -> DataFrame:
    """Per file its name in labels: the stem, and part of the path's hash where another file has that stem too."""
    stem = F.regexp_replace(F.element_at(F.split("_file", "/"), -1), r"\.[^.]+$", "")
    known = files.withColumn("_stem", stem)
    same = known.groupBy("_stem").agg(F.count(F.lit(1)).alias("_same"))
    marked = F.concat("_stem", F.lit("~"), F.substring(F.sha2(F.col("_file"), 256), 1, 8))
    return known.join(same, "_stem").withColumn("_stem", F.when(F.col("_same") > 1, marked).otherwise(F.col("_stem"))).drop("_same")


def _bronze(rows: DataFrame, columns: Sequence[str], na_tokens: Sequence[str], source_col: str, with_overflow: bool, overflow) -> DataFrame:
    """Values by column name (``_place``: where a file has the column) plus the lineage columns."""
    na, name = list(na_tokens), F.element_at(F.split("_file", "/"), -1)
    text = []
    for i, c in enumerate(columns):
        at = F.get("_place", F.lit(i))
        v = F.when(at >= 0, F.get("_vals", at))
        text.append((F.when(~v.isin(na), v) if na else v).alias(c))
    return rows.select(
        *text,
        F.concat("_stem", F.lit(":row:"), F.col("_record").cast("string")).alias(source_col),
        name.alias("source_file"), F.col("_file").alias("source_path"),
        F.substring(F.sha2(F.col("_file"), 256), 1, 16).alias("source_id"),
        F.col("_record").alias("record_no"), *([overflow.alias(OVERFLOW)] if with_overflow else []))


def find_varying_header(df: DataFrame, id_values: Sequence[str], file_col: str = "source_file",
                        record_col: str = "record_no") -> DataFrame:
    """Per file, the first record holding every marker value is the header row;
    it and the rows above it are dropped. The header row numbers are one row per file
    (a small aggregate joined back)."""
    data_cols = [c for c in df.columns if c not in (file_col, record_col, "Source", "source_file", "source_path", "source_id", OVERFLOW)]
    vals = F.array(*[F.col(f"`{c}`") for c in data_cols])
    has_all = None
    for v in id_values:
        h = F.array_contains(vals, v)
        has_all = h if has_all is None else has_all & h
    hdr = df.filter(has_all).groupBy(file_col).agg(F.min(record_col).alias("_hdr"))
    return (df.join(hdr, file_col, "left")
            .filter(F.col("_hdr").isNull() | (F.col(record_col) > F.col("_hdr"))).drop("_hdr"))


def write_csv(df: DataFrame, path: str, partition_by: Sequence[str] = (), header: bool = True) -> None:
    """CSV sink (exception reports, S29)."""
    w = df.write.mode("overwrite").option("header", str(header).lower())
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.csv(path)
