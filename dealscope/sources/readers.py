"""Readers for the opportunity sources (CSV with explicit schema, or parquet)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import SOURCE_SCHEMAS


class MissingColumnError(ValueError):
    pass


def read_source(spark: SparkSession, name: str, path: str, fmt: str = "csv", multi_line: bool = True) -> DataFrame:
    """Read one source table.

    CSV columns are matched by the header's names, in any order; a missing one fails.
    Everything is read as text; typing happens in the mart, where a bad value becomes NULL
    instead of failing the job.  Quotes inside a quoted field are doubled, and a quoted field
    may hold line breaks.  ``multi_line=False`` gives up the latter, which lets Spark split
    large files among tasks.  Only the empty string is read as NULL; ``NA`` stays a value.
    """
    if fmt == "csv":
        found = (spark.read.option("header", True).option("inferSchema", False).option("enforceSchema", False)
                 .option("mode", "PERMISSIVE").option("nullValue", "").option("quote", '"').option("escape", '"')
                 .option("multiLine", multi_line).csv(path))
        missing = [f.name for f in SOURCE_SCHEMAS[name] if f.name not in found.columns]
        if missing:
            raise MissingColumnError(f"{name}: no column {', '.join(missing)} in {path}")
        return found.select(*[F.col(f"`{f.name}`").cast(f.dataType) for f in SOURCE_SCHEMAS[name]])
    if fmt == "parquet":
        return spark.read.parquet(path)
    if fmt == "json":
        return spark.read.json(path)
    raise ValueError(f"unsupported format {fmt!r}")


def read_sources(spark: SparkSession, paths: dict[str, str], fmt: str = "csv", multi_line: bool = True) -> dict[str, DataFrame]:
    """Read the four sources named ``sales_pipeline``, ``accounts``, ``products``
    and ``sales_teams``; ``multi_line`` as in :func:`read_source`."""
    return {name: read_source(spark, name, path, fmt, multi_line) for name, path in paths.items()}


def table_versions(spark: SparkSession, paths: list[str]) -> tuple:
    """What tells a rewritten table from the one before: number, bytes and a hash of (path, time, length) of
    all files, nested ones included, listed by Spark itself."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(paths))
    found = files.agg(F.count(F.lit(1)), F.sum("length"), F.sum(F.xxhash64("path", "modificationTime", "length").cast("decimal(38,0)"))).first()
    return tuple(found)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one of the driver's parquet tables, listed anew on every call."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
