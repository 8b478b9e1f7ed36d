"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from recsift.plans.session import staging_dir


#: Bytes after which a row group of rows of megabytes is closed.
GROUP_BYTES = 16 << 20


def staged(df: DataFrame, name: str, compression: str = "snappy", wide: bool = False) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage: what is computed twice from the result is not computed twice, and a lost
    executor costs no recomputation, because every executor reaches the folder. ``wide`` rows have
    megabytes each: the writer, which else holds a hundred rows before it looks at their bytes, looks
    after each, so that it and later readers hold a few rows at a time.
    """
    spark = df.sparkSession
    path = f"{staging_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    out = df.write.option("compression", compression)
    if wide:
        out = out.option("parquet.block.size", GROUP_BYTES).option("parquet.page.size.row.check.min", 1).option("parquet.page.size.row.check.max", 1)
    out.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
