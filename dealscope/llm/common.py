"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dealscope.session import ship_package, written


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def utf8(col: Column | str) -> Column:
    """UTF-8 bytes of a text column; NULL counts as the empty text."""
    col = F.col(col) if isinstance(col, str) else col
    return F.coalesce(col.cast("binary"), F.lit(b""))


def session_of(df: DataFrame) -> SparkSession:
    """The session of ``df``, with this package sent to its Python workers (once)."""
    spark = df.sparkSession
    ship_package(spark)
    return spark


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have, whatever columns it brings along."""
    taken = {c.lower() for c in df.columns}
    name = base
    while name.lower() in taken:
        name += "_"
    return name


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and read it back.

    Cuts lineage: what follows survives the loss of executors without running
    the expensive part again.  ``session.scratch`` deletes such folders at the end of its block.
    """
    return written(df, label)


def width(spark: SparkSession) -> int:
    """Shuffle partitions of the session, for explicit repartitioning by key."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
