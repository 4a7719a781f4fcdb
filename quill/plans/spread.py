"""Parallelism for CPU-heavy work on few input files."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt evenly over all cores if it comes from fewer files than there are cores: a
    small file is one row group, which one task would read and work on alone. Inputs
    of many files stay where they are; rows are the same either way."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if len(df.inputFiles()) < cores else df
