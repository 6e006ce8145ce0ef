"""Experiments and KPIs: assignment, exposure, readout, rollups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.columns import column, hash_bucket, names
from strata.operators.guards import present
from strata.operators.skew import large_groups, spread_join
from strata.session import shared_dir

BUCKETS = 10_000


def assign_arms(users: DataFrame, key: str, salt: str, weights: Mapping[str, float] | None = None) -> DataFrame:
    """Give every user an arm by a salted hash, in proportion to the weights (50/50 by default)."""
    weights = weights or {"control": 0.5, "treatment": 0.5}
    total = sum(weights.values())
    arm, edge = None, 0.0
    last = list(weights)[-1]
    bucket = hash_bucket(key, salt, BUCKETS)
    for name, weight in weights.items():
        edge += weight
        upper = BUCKETS if name == last else round(BUCKETS * edge / total)
        test = bucket < F.lit(upper)
        arm = F.when(test, F.lit(name)) if arm is None else arm.when(test, F.lit(name))
    return users.withColumn("arm", arm)


def exposures(events: DataFrame, arms: DataFrame, user: str, ts: str, event: str, name: str, experiment: str) -> DataFrame:
    """First exposure of each user, in its assigned arm: user, ``experiment``, ``arm``, ``first_exposure``.

    The event log is reduced to one row per user before the join.
    """
    first = present(events, [user]).where(F.col(event) == name).groupBy(user).agg(F.min(ts).alias("first_exposure"))
    return first.join(arms.select(user, "arm"), user).select(user, F.lit(experiment).alias("experiment"), "arm", "first_exposure")


def experiment_readout(
    exposed: DataFrame, outcomes: DataFrame, user: str, ts: str, value: str, control: str = "control", most: int = 1_000_000
) -> DataFrame:
    """Per arm: users, conversions and value after first exposure, lift over control, two-proportion z.

    Outcomes count strictly after the first exposure; a user without any counts
    as 0. Values are added as decimals, so the totals do not depend on row order.
    The rows of users with more than ``most`` outcomes are joined where they are.
    """
    # exposures, a row per user, are computed once: both the arms' sizes and the join read them
    spark = exposed.sparkSession
    path = shared_dir(spark, "exposed")
    exposed.select(user, "experiment", "arm", "first_exposure").write.parquet(path)
    exposed = spark.read.schema(exposed.select(user, "experiment", "arm", "first_exposure").schema).parquet(path)
    arms = exposed.groupBy("experiment", "arm").agg(F.count(F.lit(1)).alias("users"))
    amount = F.col(value).cast("decimal(18,2)")
    after = spread_join(
        outcomes.select(user, F.col(ts).alias("_ts"), amount.alias("_value")),
        exposed.select(user, "experiment", "arm", "first_exposure"), user, large_groups(outcomes, user, most),
    ).where(F.col("_ts") > F.col("first_exposure"))
    per_user = after.groupBy("experiment", "arm", user).agg(F.sum("_value").alias("_value"))
    totals = per_user.groupBy("experiment", "arm").agg(
        F.count(F.lit(1)).alias("conversions"), F.sum("_value").cast("double").alias("total_value"))
    arms = arms.join(totals, ["experiment", "arm"], "left").fillna({"total_value": 0.0, "conversions": 0})
    rates = arms.withColumns({
        "conversion_rate": F.try_divide(F.col("conversions"), F.col("users")),
        "value_per_user": F.try_divide(F.col("total_value"), F.col("users")),
    })
    # one row per arm by now: the control's figures come from a window over the experiment
    whole = Window.partitionBy("experiment")

    def of_control(name: str) -> Column:
        return F.max(F.when(F.col("arm") == control, F.col(name))).over(whole)

    both = rates.withColumns({
        "_n": of_control("users"), "_x": of_control("conversions"),
        "_p": of_control("conversion_rate"), "_v": of_control("value_per_user")})
    pooled = F.try_divide(F.col("conversions") + F.col("_x"), F.col("users") + F.col("_n"))
    error = F.sqrt(pooled * (1 - pooled) * (F.try_divide(F.lit(1), F.col("users")) + F.try_divide(F.lit(1), F.col("_n"))))
    other = F.col("arm") != control
    return both.select(
        *rates.columns,
        F.when(other, F.try_divide(F.col("conversion_rate"), F.col("_p")) - 1).alias("lift"),
        F.when(other, F.try_divide(F.col("value_per_user"), F.col("_v")) - 1).alias("value_lift"),
        F.when(other, F.try_divide(F.col("conversion_rate") - F.col("_p"), error)).alias("z"),
    )


def kpi_rollup(df: DataFrame, measures: Mapping[str, str | Column], grain: str | Sequence[str]) -> DataFrame:
    """Additive measures per unit of ``grain`` (level ``unit``) and over all of them (level ``aggregate``).

    The aggregate is the sum of the units, so the two always agree.
    """
    units = names(grain)
    per_unit = df.groupBy(*units).agg(*[F.sum(column(m)).alias(n) for n, m in measures.items()])
    sets = [[F.col(u) for u in units], []]
    out = per_unit.groupingSets(sets, *[F.col(u) for u in units]).agg(
        F.when(F.grouping_id() == 0, "unit").otherwise("aggregate").alias("level"),
        *[F.sum(n).alias(n) for n in measures])
    return out.select("level", *units, *measures)
