"""File discovery and assignment.

The listing is a DataFrame (``binaryFile`` source with the content column pruned),
so listing a bucket with millions of objects is a distributed job, not a driver loop.
The same functions take ``s3a://`` / ``abfss://`` roots (S13).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Tabular suffixes recognised by discovery, and the default ignore words.
TABULAR_SUFFIXES = [".xlsx", ".xls", ".xlsm", ".txt", ".csv", ".xlsb", ".pkl"]
DEFAULT_IGNORE = ["archive", "delete"]


def list_files(spark: SparkSession, root: str | Sequence[str],
               suffixes: Sequence[str] = TABULAR_SUFFIXES) -> DataFrame:
    """Recursive listing ``(path, name, parent, stem, suffix, length,
    modificationTime)`` of files whose lower-cased suffix is in ``suffixes``. A list
    of explicit paths is accepted too (S3). File contents are not read."""
    paths = [root] if isinstance(root, str) else list(root)
    lst = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
           .select("path", "length", "modificationTime"))
    name = F.element_at(F.split("path", "/"), -1)
    suffix = F.lower(F.regexp_extract(name, r"(\.[^.]+)$", 1))
    out = lst.select(
        "path", name.alias("name"),
        F.regexp_replace("path", r"/[^/]*$", "").alias("parent"),
        F.regexp_replace(name, r"\.[^.]+$", "").alias("stem"),
        suffix.alias("suffix"), "length", "modificationTime")
    return out.filter(F.col("suffix").isin([s.lower() for s in suffixes]))


def _all(conds: list[Column]) -> Column:
    out = F.lit(True)
    for c in conds:
        out = out & c
    return out


def file_filter_condition(filename_include: Sequence[str] = (), filename_exclude: Sequence[str] = (),
                          filepath_exclude: Sequence[str] | None = None) -> Column:
    """S2 predicate: every include keyword in the file *name* (case-sensitive), no
    exclude keyword in the name, no ignore keyword in the *parent path*
    (case-insensitive). Empty keywords are skipped."""
    ignore = DEFAULT_IGNORE if filepath_exclude is None else filepath_exclude
    inc = [F.col("name").contains(k) for k in filename_include if k]
    exc = [~F.col("name").contains(k) for k in filename_exclude if k]
    ign = [~F.lower(F.col("parent")).contains(k.lower()) for k in ignore if k]
    return _all(inc + exc + ign)


def filelist_filter(listing: DataFrame, filename_include: Sequence[str] = (),
                    filename_exclude: Sequence[str] = (), filepath_exclude: Sequence[str] | None = None,
                    fail_if_empty: bool = False) -> DataFrame:
    """S2 (+S4 with ``fail_if_empty``)."""
    out = listing.filter(file_filter_condition(filename_include, filename_exclude, filepath_exclude))
    if fail_if_empty and out.isEmpty():
        raise ValueError("no file matches the filter")
    return out


def assign_datasets(listing: DataFrame, read_settings: Mapping[str, Mapping]) -> DataFrame:
    """Assign each file to a dataset with its read options.

    ``read_settings``: ``{dataset: {filename_include, filename_exclude, filepath_exclude,
    options: {...}}}``. A file matching several datasets keeps the **last** one in
    settings order. One pass: each rule is a column predicate, and the last match
    is taken with ``element_at`` over the matching rule names (no join, no shuffle).
    """
    import json
    names = list(read_settings)
    hits = F.filter(F.array(*[
        F.when(file_filter_condition(s.get("filename_include", ()), s.get("filename_exclude", ()),
                                     s.get("filepath_exclude")), F.lit(i)) for i, s in enumerate(read_settings.values())]),
        lambda x: x.isNotNull())
    last = F.try_element_at(hits, F.lit(-1))
    ds = F.element_at(F.array(*[F.lit(n) for n in names]), last + 1)
    opts = F.element_at(F.array(*[F.lit(json.dumps(dict(s.get("options", {})), sort_keys=True))
                                  for s in read_settings.values()]), last + 1)
    return (listing.withColumn("_last", F.when(F.size(hits) > 0, last))
            .filter(F.col("_last").isNotNull())
            .withColumn("dataset", ds).withColumn("read_options", opts).drop("_last"))


def require_files(listing: DataFrame) -> DataFrame:
    """Raise when a listing is empty (cheap ``isEmpty`` check)."""
    if listing.isEmpty():
        raise ValueError("file listing is empty")
    return listing
