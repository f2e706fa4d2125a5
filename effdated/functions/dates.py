"""Date functions: parsing (P12-P13), sentinels (P14-P16), week parts (P21), financial year."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# pandas' largest timestamp (microsecond precision) is the open-end sentinel.
MAX_DATE = "2262-04-11 23:47:16.854775"

# Day-first and ISO layouts tried in order by change_date_format.
DAYFIRST_PATTERNS = [
    "d/M/yyyy H:mm:ss", "d/M/yyyy H:mm", "d/M/yyyy", "d/M/yy",
    "d-M-yyyy H:mm:ss", "d-M-yyyy", "d.M.yyyy",
    "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm", "yyyy-MM-dd",
    "d MMM yyyy", "d-MMM-yyyy", "d-MMM-yy",
]
MONTHFIRST_PATTERNS = [
    "M/d/yyyy H:mm:ss", "M/d/yyyy H:mm", "M/d/yyyy", "M/d/yy",
    "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm", "yyyy-MM-dd",
    "MMM d yyyy", "d MMM yyyy",
]

_STRFTIME = {"%Y": "yyyy", "%m": "MM", "%d": "dd", "%H": "HH", "%M": "mm", "%S": "ss",
             "%y": "yy", "%b": "MMM", "%B": "MMMM", "%f": "SSSSSS", "%I": "hh", "%p": "a"}


def parse_datetime(c: Column | str, dayfirst: bool = True) -> Column:
    """Text -> timestamp_ntz trying the day-first (or month-first) layouts; null if none fit."""
    col = F.trim(F.col(c) if isinstance(c, str) else c)
    pats = DAYFIRST_PATTERNS if dayfirst else MONTHFIRST_PATTERNS

    def tried(text: Column, p: str) -> Column:
        # a text without the layout's separators cannot fit it: looking for them is cheaper than a failing parse
        marks = [F.contains(text, F.lit(m)) for m in "/-.: " if m in p]
        return F.when(reduce(and_, marks), F.try_to_timestamp(text, F.lit(p)).cast("timestamp_ntz"))

    # in a lambda, since the code generated for so many layouts is too long for the JVM to compile
    return F.get(F.transform(F.array(col), lambda text: F.coalesce(*[tried(text, p) for p in pats])), F.lit(0))


def change_date_format(df: DataFrame, target_col: str, dayfirst: bool = True,
                       errors: str = "coerce") -> DataFrame:
    """Parse a text date column in place. ``errors='raise'`` fails the job on the
    first unparseable non-empty value; ``'coerce'`` turns it into null."""
    src = F.col(target_col)
    if dict(df.dtypes).get(target_col, "string").startswith("timestamp"):
        return df
    parsed = parse_datetime(src.cast("string"), dayfirst)
    if errors == "raise":
        bad = src.isNotNull() & (F.trim(src.cast("string")) != "") & parsed.isNull()
        parsed = F.when(bad, F.raise_error(F.concat(F.lit(f"unparseable date in {target_col}: "),
                                                     src.cast("string")))).otherwise(parsed)
    return df.withColumn(target_col, parsed.cast("timestamp_ntz"))


def strftime_to_spark(fmt: str) -> str:
    out = fmt
    for k, v in _STRFTIME.items():
        out = out.replace(k, v)
    return out


def parse_with_format(c: str, fmt: str) -> Column:
    """``pd.to_datetime(c, format=fmt)`` with a strftime format."""
    return F.to_timestamp(F.col(c), strftime_to_spark(fmt)).cast("timestamp_ntz")


def fill_null_with_max_date(df: DataFrame, target_col: str, sentinel: str = MAX_DATE) -> DataFrame:
    """Null end date -> open-end sentinel."""
    return df.withColumn(target_col, F.coalesce(F.col(target_col),
                                                F.lit(sentinel).cast("timestamp_ntz")))


def add_n_days(df: DataFrame, date_col_name: str, number_of_days: int) -> DataFrame:
    """Shift a date by whole days (closed periods become half-open with n=1)."""
    return df.withColumn(date_col_name, F.col(date_col_name) + F.make_dt_interval(F.lit(number_of_days)))


def week_parts(df: DataFrame, date_column: str) -> DataFrame:
    """ISO ``week_number``, ``week_day`` (Monday=0) and ``week_info`` = ``<iso year>-W<ww>``."""
    d = F.col(date_column)
    year_of_week = F.expr(f"extract(YEAROFWEEK FROM `{date_column}`)")
    return df.withColumns({
        "week_number": F.weekofyear(d),
        "week_day": F.weekday(d),
        "week_info": F.concat(year_of_week.cast("string"), F.lit("-W"),
                              F.lpad(F.weekofyear(d).cast("string"), 2, "0")),
    })


def financial_year(d: Column | str, start_month: int = 7) -> Column:
    """Financial year label = year of its last day (1 July - 30 June -> ending year)."""
    col = F.col(d) if isinstance(d, str) else d
    return (F.year(col) + F.when(F.month(col) >= start_month, 1).otherwise(0)).cast("int")


def matching_financial_year(df: DataFrame, end: str, fy_start: int, fy_end: int,
                            out: str = "fy", start_month: int = 7) -> DataFrame:
    """P22 (YAML form): label rows by FY of ``end``; years outside [fy_start, fy_end] -> null."""
    fy = financial_year(end, start_month)
    return df.withColumn(out, F.when(fy.between(fy_start, fy_end), fy))


def fy_bounds(fy: Column, start_month: int = 7) -> tuple[Column, Column]:
    """First and last day of financial year ``fy``."""
    start = F.make_date(fy - 1, F.lit(start_month), F.lit(1))
    end = F.date_sub(F.make_date(fy, F.lit(start_month), F.lit(1)), 1)
    return start, end
