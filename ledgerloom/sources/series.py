"""Observation series.

A series file (CSV or Parquet export of a workbook sheet) holds a date
column and a value column.  Column choice follows the source rules: names
are stripped and lower-cased; the date column is ``date`` or
``observation_date``, else the first column holding any parseable date; the
value column is the first other column holding any number.  One aggregate
pass over the file answers both questions for every column.

In a folder of exports the choice is made file by file: the first lines of each
file decide most columns, and only what they leave open (a column before the
chosen one that might still hold a date or a number) is asked of all lines, by
file, in one aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.money import parse_number
from ..session import ensure_checkpoint_dir
from . import csv_files

# Date layouts accepted in text date columns.
DATE_FORMATS = ["yyyy-MM-dd", "yyyy/MM/dd", "MM/dd/yyyy", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss"]
DATE_NAMES = ("date", "observation_date")


def parse_date(c) -> Column:
    """text / date / timestamp → date, failures NULL."""
    c = F.col(c) if isinstance(c, str) else c
    s = F.regexp_replace(c.cast("string"), r"^\s+|\s+$", "")
    return F.coalesce(*[F.try_to_date(s, f) for f in DATE_FORMATS])


def _as_date(df: DataFrame, name: str) -> Column:
    t = df.schema[name].dataType
    if isinstance(t, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.col(f"`{name}`").cast("date")
    return parse_date(F.col(f"`{name}`"))


def _as_number(df: DataFrame, name: str) -> Column:
    t = df.schema[name].dataType
    if isinstance(t, T.NumericType):
        return F.col(f"`{name}`").cast("double")
    return parse_number(F.col(f"`{name}`"))


def _parseable(df: DataFrame, cols: list[str]) -> dict[str, tuple[bool, bool]]:
    """For every column: does any row parse as a date, does any parse as a
    number?  One aggregate pass (partial on every task, one row out)."""
    if not cols:
        return {}
    aggs = []
    for i, c in enumerate(cols):
        aggs.append(F.bool_or(_as_date(df, c).isNotNull()).alias(f"d{i}"))
        aggs.append(F.bool_or(_as_number(df, c).isNotNull()).alias(f"n{i}"))
    row = df.agg(*aggs).first()
    return {c: (bool(row[f"d{i}"]), bool(row[f"n{i}"])) for i, c in enumerate(cols)}


def series_from_frame(df: DataFrame, series_col: str | None = None) -> DataFrame:
    """S5 on a frame: choose the date and value columns, coerce them, drop
    rows where either is NULL.  Returns ``series_id, date, value``;
    ``series_col`` (optional) names a column kept as the series id."""
    df = df.toDF(*[c.strip().lower() for c in df.columns])
    sid_name = None if series_col is None else series_col.strip().lower()
    found = _parseable(df, [c for c in df.columns if c != sid_name])
    # Candidates ranked: a name that says date first, then any that parses.
    dates = sorted((c not in DATE_NAMES, place, c) for place, (c, (is_date, _)) in enumerate(found.items()) if is_date or c in DATE_NAMES)
    numbers = [c for c, (_, is_number) in found.items() if is_number and (not dates or c != dates[0][2])]
    if not dates or not numbers:
        return _empty_series(df.sparkSession)
    date_col, val_col = dates[0][2], numbers[0]
    sid = F.col(f"`{sid_name}`").cast("string") if sid_name else F.lit(None).cast("string")
    out = df.select(sid.alias("series_id"), _as_date(df, date_col).alias("date"),
                    _as_number(df, val_col).alias("value"))
    return out.dropna(subset=["date", "value"])


def read_series(spark: SparkSession, path: str, fmt: str = "csv", series_id: str | None = None) -> DataFrame:
    """Read one exported series; an absent file gives an empty series."""
    if fmt == "csv" and len(csv_files.data_files(spark, path)) > 1:
        out = read_series_folder(spark, path)
        return out.withColumn("series_id", F.lit(series_id).cast("string")) if series_id is not None else out
    try:
        if fmt == "csv":
            df = spark.read.option("header", True).csv(path)
        else:
            df = spark.read.format(fmt).load(path)
    except Exception as e:  # absent path → absent source (S7)
        if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e):
            return _empty_series(spark)
        raise
    out = series_from_frame(df)
    return out.withColumn("series_id", F.lit(series_id).cast("string")) if series_id is not None else out


#: Lines of each export that are looked at first.
FIRST_LINES = 50


def read_series_folder(spark: SparkSession, path: str, first_lines: int = FIRST_LINES) -> DataFrame:
    """S5 over a folder of CSV exports whose layouts differ: ``series_id``
    (the file's name), ``date, value``.  A folder without files, and a file
    without a date and a value column, give no rows."""
    files = csv_files.data_files(spark, path)
    if not files:
        return _empty_series(spark)
    ensure_checkpoint_dir(spark)
    heads = csv_files.file_heads(spark, files, first_lines).checkpoint(eager=True)
    width = heads.agg(F.max(F.size(F.split("header", ",")))).first()[0]  # cells at most
    if not width:
        return _empty_series(spark)
    heads = heads.withColumn("_names", F.transform(_cells(width, "header"), lambda n: F.lower(F.regexp_replace(n, r"^[\s\ufeff]+|\s+$", ""))))
    # By file: the columns that hold a date, or a number, among the first lines.
    seen = _votes(heads.select("name", "_names", F.explode_outer("lines").alias("value")), width, F.lit(True))
    heads = heads.drop("lines").join(seen, "name")
    named = _first(F.transform("_names", lambda n: n.isin(*DATE_NAMES)))
    date = F.coalesce(named, _first(F.col("_dates")))
    heads = heads.withColumn("_date", date).withColumn("_value", _first(_without("_numbers", F.col("_date"))))
    # Open: without a named date, the columns before the one found (or all);
    # likewise for numbers.  The date's own column takes no part in the latter.
    place = F.sequence(F.lit(0), F.lit(width - 1))
    before_date = F.transform(place, lambda i: named.isNull() & (i < F.coalesce(F.col("_date"), F.lit(width))))
    before_value = F.transform(place, lambda i: i < F.coalesce(F.col("_value"), F.lit(width)))
    heads = heads.withColumns({"_open_dates": before_date, "_open_numbers": before_value}).checkpoint(eager=True)
    still = F.exists("_open_dates", lambda x: x) | F.exists("_open_numbers", lambda x: x)
    if not heads.where(still).isEmpty():
        lines = csv_files.data_lines(spark, path, heads.where(still), len(files))
        more = _votes(lines, width, None).withColumnsRenamed({"_dates": "_more_dates", "_numbers": "_more_numbers"})
        heads = heads.join(more, "name", "left")
        for c, extra in (("_dates", "_more_dates"), ("_numbers", "_more_numbers")):
            heads = heads.withColumn(c, F.when(F.col(extra).isNull(), F.col(c)).otherwise(F.zip_with(c, extra, lambda a, b: a | b)))
        heads = heads.withColumn("_date", F.coalesce(named, _first(F.col("_dates")))).withColumn("_value", _first(_without("_numbers", F.col("_date"))))
    chosen = heads.where("_date IS NOT NULL AND _value IS NOT NULL").select("name", "preamble", "header", "_date", "_value").checkpoint(eager=True)
    lines = csv_files.data_lines(spark, path, chosen, len(files)).select("name", "_date", "_value", csv_files.once(_cells(width)).alias("_cells"))
    rows = lines.select(F.col("name").alias("series_id"), csv_files.once(parse_date(F.get("_cells", "_date"))).alias("date"), F.get("_cells", "_value").alias("value"))
    rows = rows.select("series_id", "date", parse_number("value").alias("value"))
    return rows.dropna(subset=["date", "value"])


def _cells(width: int, line: str = "value") -> Column:
    """The cells of a CSV line, padded or cut to ``width``."""
    schema = ", ".join(f"c{i} string" for i in range(width))
    row = F.from_csv(line, F.lit(schema), {"mode": "PERMISSIVE"})
    return F.array(*[row[f"c{i}"] for i in range(width)])


def _votes(lines: DataFrame, width: int, ask: Column | None) -> DataFrame:
    """``name, _dates, _numbers``: which columns of a file hold any date, any
    number; ``ask`` (or else the open flags) says which are looked at."""
    lines = lines.withColumn("_cells", _cells(width))
    aggs = []
    for kind, parsed, open_ in (("_dates", parse_date, "_open_dates"), ("_numbers", parse_number, "_open_numbers")):
        for i in range(width):
            wanted = ask if ask is not None else F.col(open_)[i]
            aggs.append(F.coalesce(F.bool_or(F.when(wanted, parsed(F.col("_cells")[i]).isNotNull())), F.lit(False)).alias(f"{kind}{i}"))
    votes = lines.groupBy("name").agg(*aggs)
    return votes.select("name", *[F.array(*[F.col(f"{kind}{i}") for i in range(width)]).alias(kind) for kind in ("_dates", "_numbers")])


def _first(flags: Column) -> Column:
    """The place of the first true flag, from 0; NULL if there is none."""
    return F.nullif(F.array_position(flags, F.lit(True)), F.lit(0)).cast("int") - 1


def _without(flags: str, place: Column) -> Column:
    """Flags with one place turned off."""
    return F.transform(flags, lambda x, i: x & ~i.eqNullSafe(place))


def _empty_series(spark: SparkSession) -> DataFrame:
    from ..contracts import OBSERVATIONS

    return spark.createDataFrame([], OBSERVATIONS)
