"""Steps written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..session import scratch_path


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet under the shared folder and read back: computed
    once, counted from its footers, and kept when executors are lost."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
