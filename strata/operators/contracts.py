"""Table contracts: unique keys, required columns, allowed values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with the number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def check_contract(
    df: DataFrame,
    keys: Sequence[str] = (),
    not_null: Sequence[str] = (),
    domains: Mapping[str, Sequence] | None = None,
) -> DataFrame:
    """Violations as rows (rule, columns, violations); no rows when the table is clean.

    ``violations`` counts surplus rows for ``unique`` and offending rows for
    ``not_null`` and ``domain``. The row checks share one scan; nulls are left to
    the ``not_null`` rule.
    """
    checks = []
    for c in not_null:
        checks.append(("not_null", c, F.count_if(F.col(c).isNull())))
    for c, allowed in (domains or {}).items():
        checks.append(("domain", c, F.count_if(~F.col(c).isin(*allowed))))
    parts = []
    if checks:
        counts = df.agg(F.array(*[
            F.struct(F.lit(rule).alias("rule"), F.lit(c).alias("columns"), n.alias("violations")) for rule, c, n in checks
        ]).alias("found"))
        parts.append(counts.select(F.inline("found")))
    if keys:
        surplus = duplicate_keys(df, keys).agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("violations"))
        parts.append(surplus.select(F.lit("unique").alias("rule"), F.lit(",".join(keys)).alias("columns"), "violations"))
    if not parts:
        raise ValueError("the contract is empty")
    return reduce(DataFrame.unionByName, parts).where("violations > 0")


def write_checked(
    df: DataFrame,
    path: str,
    keys: Sequence[str] = (),
    not_null: Sequence[str] = (),
    domains: Mapping[str, Sequence] | None = None,
) -> DataFrame:
    """Write a table as Parquet and return the violations of its contract, as ``check_contract`` does, without another pass over its rows.

    Nulls and values outside their domain are counted while the rows are written; the counts, one number a rule, are
    taken from the writing job. Only unique keys need a pass of their own, which reads the written key columns. The table
    is written whether or not it breaks the contract.
    """
    if not keys and not not_null and not domains:
        raise ValueError("the contract is empty")
    checks = [("not_null", c, F.col(f"`{c}`").isNull()) for c in not_null]
    checks += [("domain", c, ~F.col(f"`{c}`").isin(*allowed)) for c, allowed in (domains or {}).items()]
    spark, seen = df.sparkSession, Observation()
    counts = [F.count_if(broken).alias(f"n{k}") for k, (_, _, broken) in enumerate(checks)]
    (df.observe(seen, *counts) if counts else df).write.mode("overwrite").parquet(path)
    found = [(rule, c, seen.get[f"n{k}"]) for k, (rule, c, _) in enumerate(checks)]
    out = spark.createDataFrame([f for f in found if f[2]], "rule string, columns string, violations bigint")
    if keys:
        out = out.unionByName(check_contract(spark.read.schema(df.schema).parquet(path), keys=keys))
    return out
