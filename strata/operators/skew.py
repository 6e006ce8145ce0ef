"""Ways to keep one hot key out of a single task, exact for any distribution."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.columns import column, names
from strata.operators.guards import broadcastable, maybe_broadcast
from strata.session import shared_dir


def large_groups(df: DataFrame, key: str | Sequence[str], most: int) -> DataFrame | None:
    """Keys of more than ``most`` rows with their size ``_n``, or None where there are none.

    One counting job over the key columns, whose few result rows are stored in the
    shared folder. The caller picks the plain form of its plan where no group is
    large, which is cheaper than guarding every group.
    """
    spark = df.sparkSession
    keys = names(key)
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > most)
    path = shared_dir(spark, "large-groups")
    sizes.write.parquet(path)
    large = spark.read.schema(sizes.schema).parquet(path)
    return None if large.isEmpty() else large


def with_keys(df: DataFrame, keys_df: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Semi or anti join on the key columns, null matching null."""
    other = keys_df.select(*[F.col(k).alias(f"_key_{n}") for n, k in enumerate(keys)])
    same = F.lit(True)
    for n, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_key_{n}"))
    return df.join(other, same, how)


def spread_join(fact: DataFrame, dim: DataFrame, key: str | Sequence[str], large: DataFrame | None, how: str = "inner") -> DataFrame:
    """Join many rows per key to the rows of a key in ``dim``, with the rows of large keys left where they are.

    ``large`` comes from ``large_groups`` over the fact. The dimension rows of large
    keys are broadcast if their size, which is measured, allows it. All other rows, and
    everything where the list of keys is too long to broadcast, join by shuffle.
    """
    keys = names(key)
    if large is None or not broadcastable(large):
        return fact.join(dim, keys, how)
    hot = F.broadcast(large.select(*keys))
    rest = with_keys(fact, hot, keys, "left_anti").join(dim, keys, how)
    few = maybe_broadcast(with_keys(dim, hot, keys, "left_semi"))
    return rest.unionByName(with_keys(fact, hot, keys, "left_semi").join(few, keys, how))


def running_totals(
    df: DataFrame,
    key: str | Sequence[str],
    day: str,
    seq: str,
    totals: dict[str, str],
    width: int = 1_000_000,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Running sums per key in the order (day, seq), without a task that holds a large key.

    ``totals`` maps a new column to the integer column it accumulates. ``seq`` is of
    any orderable type; nulls come first. Keys of up to ``width`` rows are summed
    by one window; larger keys by ``blocked_totals``, with the same result. Sizes are taken from
    ``counted``, a cheaper table that holds at least the rows of ``df``.
    """
    keys = names(key)
    large = large_groups(df if counted is None else counted, keys, width)
    if large is None:
        return _plain_totals(df, keys, day, seq, totals)
    large = maybe_broadcast(large.select(*keys))
    rest = _plain_totals(with_keys(df, large, keys, "left_anti"), keys, day, seq, totals)
    return rest.unionByName(blocked_totals(with_keys(df, large, keys, "left_semi"), keys, day, seq, totals))


def _plain_totals(df, keys, day, seq, totals):
    w = Window.partitionBy(*keys).orderBy(day, seq).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumns({out: F.sum(src).over(w) for out, src in totals.items()})


def blocked_totals(df, keys, day, seq, totals, parts: int | None = None):
    """Running totals by position: rows are cut into ``parts`` blocks of their order (key, day, seq).

    The cut is a range partitioning by position, so a block has about as many rows as any
    other, whatever the values are. The blocks are stored with their number (a second
    sampling could cut elsewhere); a window inside each block and the totals
    of a key's earlier blocks, a row per key and block, make the sums. Null keys,
    days and ids are values like others.
    """
    spark = df.sparkSession
    n = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = shared_dir(spark, "blocks")
    cut = df.repartitionByRange(n, *keys, day, seq).withColumn("_block", F.spark_partition_id())
    cut.write.parquet(path)
    rows = spark.read.schema(cut.schema).parquet(path)
    per_block = rows.groupBy(*keys, "_block").agg(*[F.sum(src).alias("_t_" + out) for out, src in totals.items()])
    earlier = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_block.select(
        *[F.col(k).alias(f"_key_{i}") for i, k in enumerate(keys)], F.col("_block").alias("_of"),
        *[F.coalesce(F.sum("_t_" + out).over(earlier), F.lit(0)).alias("_o_" + out) for out in totals])
    inside = Window.partitionBy(*keys, "_block").orderBy(day, seq).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = rows.withColumns({out: F.sum(src).over(inside) for out, src in totals.items()})
    same = F.col("_block") == F.col("_of")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_key_{i}"))
    out = summed.join(offsets, same).withColumns({c: F.col(c) + F.col("_o_" + c) for c in totals})
    return out.select(*df.columns, *totals)


def part_of(value: str | Column, parts: int) -> Column:
    """Part 0 .. parts - 1 of a value: by the first 16 bits of the MD5 of its text."""
    digits = F.substring(F.md5(F.coalesce(column(value).cast("string"), F.lit("")).cast("binary")), 1, 4)
    return F.pmod(F.conv(digits, 16, 10).cast("bigint"), F.lit(parts).cast("bigint"))


def list_parts(
    df: DataFrame, key: str | Sequence[str], value: str, parts: int = 1, maxima: Sequence[str] = (), split_by: str | Column | None = None,
) -> DataFrame:
    """Sorted lists of a value per key in ``parts`` rows at most: key, ``part``, ``values``.

    The rows depend on the arguments alone, never on how many values a key has: part p holds the values
    (or those with ``split_by``) that ``part_of`` sends there, and the parts of a key together are its
    complete list. One part gives the exact list in one row. Choose more where a key may hold more
    values than a task should; a part without values has no row. ``maxima`` columns are added
    as the maximum over the whole key, in every part.
    """
    keys = names(key)
    out = df.withColumn("part", part_of(value if split_by is None else split_by, parts)).groupBy(*keys, "part").agg(
        F.sort_array(F.collect_list(value)).alias("values"), *[F.max(c).alias(c) for c in maxima])
    if maxima and parts > 1:
        whole = Window.partitionBy(*keys)  # a row per part by now
        out = out.withColumns({c: F.max(c).over(whole) for c in maxima})
    return out.select(*keys, "part", "values", *maxima)


def list_pages(df: DataFrame, key: str | Sequence[str], value: str, size: int, maxima: Sequence[str] = ()) -> DataFrame:
    """Sorted lists of a value per key in pages of ``size`` values: key, ``page`` (from 0), ``values``.

    Page p holds the values at the places p * size and following of the key's sorted list, so every page but a key's last is
    full, no row is larger than a page, and the pages of a key are its list, however long it is. Places are
    counted by ``blocked_totals``: no task orders a whole key. Give rows distinct per key and value, or values repeat.
    ``maxima`` columns are added as the maximum over the whole key, in every page. Null keys are a key, null values come first.
    """
    keys = names(key)
    ranked = blocked_totals(df.select(*keys, value, F.lit(1).alias("_one")), keys, value, value, {"_place": "_one"})
    page = F.floor((F.col("_place") - 1) / size).alias("page")
    # nulls are held inside structs, as a list would leave them out
    lists = ranked.groupBy(*keys, page).agg(F.sort_array(F.collect_list(F.struct(value)))[value].alias("values"))
    if not maxima:
        return lists
    whole = df.groupBy(*[F.col(k).alias(f"_key_{n}") for n, k in enumerate(keys)]).agg(*[F.max(c).alias(c) for c in maxima])
    same = F.lit(True)
    for n, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_key_{n}"))
    return lists.join(whole, same).select(*keys, "page", "values", *maxima)


def split_pairs(
    rows: DataFrame, counted: DataFrame, group: str, member: str, most: int = 2_000
) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides and the join columns of a self-join within ``group``; every ordered pair of rows meets once.

    Where some group has more than ``most`` rows, it is divided into c chunks by a
    hash of the member; the left copy of a row goes to the c cells of its row of
    chunks, the right copy to the c cells of its column. Each cell joins at most
    about ``most`` x ``most`` rows, and cells run in different tasks. Sizes are taken
    from ``counted``, which holds at least the rows (the raw table, of which only
    the group column is read).
    """
    large = large_groups(counted, group, most)
    if large is None:
        return rows, rows, [group]
    chunks = large.select(group, F.ceil(F.col("_n") / F.lit(most)).cast("int").alias("_c"))
    rows = rows.join(maybe_broadcast(chunks), group, "left").withColumn("_c", F.coalesce("_c", F.lit(1)))
    rows = rows.withColumn("_own", F.pmod(F.xxhash64(member), F.col("_c")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("_c") - 1))
    left = rows.withColumn("_j", other).withColumnRenamed("_own", "_i").drop("_c")
    right = rows.withColumn("_i", other).withColumnRenamed("_own", "_j").drop("_c")
    return left, right, [group, "_i", "_j"]
