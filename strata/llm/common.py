"""Helpers of the document operators: words, stored intermediate tables, packed rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import shared_dir

# A word is a run of anything but space and the control characters 9 to 13.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def stored(df: DataFrame, label: str, compression: str = "snappy") -> DataFrame:
    """``df`` written to the cluster's shared folder and read back: cuts the lineage, computes it once.

    The files outlive any executor. They are scratch files below
    ``spark.checkpoint.dir`` and may be removed when the job that made them is over.
    """
    path = shared_dir(df.sparkSession, label)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def packed(df: DataFrame, **cols: Column) -> DataFrame:
    """The given columns and the whole row as ``row``, so that no name of ``df`` can clash with a working column."""
    return df.select(*[c.alias(name) for name, c in cols.items()], F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))


def unpacked(df: DataFrame) -> DataFrame:
    return df.select("row.*")


def count_words(text: Column) -> Column:
    """Number of words; null counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased and nothing else. Text without other than ASCII characters takes the fast function."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row, however often ``body`` uses it."""
    return F.transform(F.array(value), body)[0]
