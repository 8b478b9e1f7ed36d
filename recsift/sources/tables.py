"""Table source: columns and a date range, read by the scan itself."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def load(spark: SparkSession, path: str, columns: Sequence[str] | None = None, date_col: str | None = None,
         start: str | None = None, end: str | None = None) -> DataFrame:
    """Parquet table at ``path`` with ``columns`` and ``start <= date_col <= end`` (both ends optional).

    The bounds compare the stored column with literals of its own type, so they reach the scan: a
    partition column prunes folders, any other column prunes row groups. Bounds are ``yyyyMMdd``
    strings for string columns and days for time columns (``end`` is then the whole day).
    """
    df = spark.read.parquet(path)
    if date_col is not None:
        kind = df.schema[date_col].dataType.simpleString()
        c = F.col(date_col)
        if kind.startswith(("timestamp", "date")):
            day = lambda d, plus: F.expr(f"date_add(date'{d[:4]}-{d[4:6]}-{d[6:8]}', {plus})").cast(kind)
            df = df.where(c >= day(start, 0)) if start else df
            df = df.where(c < day(end, 1)) if end else df
        else:
            df = df.where(c >= F.lit(start).cast(kind)) if start else df
            df = df.where(c <= F.lit(end).cast(kind)) if end else df
    return df.select(*columns) if columns else df


def save(df: DataFrame, path: str, date_col: str = "ymd", mode: str = "overwrite") -> None:
    """Parquet folders ``date_col=value`` under ``path``, as ``load`` prunes them.

    With ``overwrite`` only the dates in ``df`` are replaced, so a day can be written again alone. Rows are
    dealt so that a date goes to few files: tasks write whole ranges of dates, and a date too large
    for one task is several.
    """
    own = df.repartition(F.col(date_col), F.pmod(F.xxhash64(*[c for c in df.columns if c != date_col] or [date_col]), F.lit(8)))
    own.write.partitionBy(date_col).option("partitionOverwriteMode", "dynamic").mode(mode).parquet(path)
