import glob
import uuid

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from strata.operators import joins
from strata.operators.skew import large_groups
from strata.plans import storage
from strata.session import session_conf, shared_dir
from strata.sources import tables


def name():
    return "t_" + uuid.uuid4().hex[:8]


def test_read_table(spark, tmp_path):
    (tmp_path / "maps.csv").write_text("mapid,name,description\n1,Urban,Old town\n2,Raid,\n,Lost,x\n")
    path = str(tmp_path / "maps.csv")
    typed = tables.read_table(spark, path, "csv", "mapid int, name string, description string", require=["mapid"])
    assert rows(typed) == [(1, "Urban", "Old town"), (2, "Raid", None)]
    assert dict(tables.read_table(spark, path, "csv").dtypes)["mapid"] == "string"
    assert dict(tables.read_table(spark, path, "csv", infer=True).dtypes)["mapid"] == "int"


def test_write_period_replaces_only_its_period(spark, tmp_path):
    t = name()
    one = spark.createDataFrame([("a", 1, 10), ("b", 2, 20)], "k string, p int, v int")
    tables.write_period(one, t, "p", str(tmp_path / "t"))
    again = spark.createDataFrame([(21, "c", 2)], "v int, k string, p int")  # other column order
    for _ in range(2):
        tables.write_period(again, t, "p")
    assert rows(spark.table(t).select("k", "p", "v")) == [("a", 1, 10), ("c", 2, 21)]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_materialize(spark, tmp_path):
    t = name()
    for n in (3, 2):
        assert tables.materialize(spark.range(n), t, path=str(tmp_path / "m")).count() == n


def test_bucket_join_has_no_shuffle(spark, tmp_path):
    left = spark.range(2000).select((F.col("id") % 300).alias("k"), "id")
    right = spark.range(300).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    l, r = name(), name()
    tables.write_bucketed(left, l, "k", 8, sort=["k", "id"], path=str(tmp_path / "l"))
    tables.write_bucketed(right, r, "k", 8, path=str(tmp_path / "r"))
    out = joins.bucket_join(spark, l, r, "k", where=F.col("id") >= 10)
    assert rows(out) == rows(left.join(right, "k").where("id >= 10"))
    assert "Exchange" not in plan(out) and "SortMergeJoin" in plan(out)
    assert len(glob.glob(str(tmp_path / "l" / "*.parquet"))) <= 8  # one file per bucket


@pytest.mark.parametrize("hot_left,hot_right", [(True, False), (False, True), (True, True)])
def test_bucket_join_with_hot_keys(spark, tmp_path, hot_left, hot_right):
    """Every row stays in its table, and hot keys joined apart give the same rows."""
    base = spark.range(60).select((F.col("id") % 20).alias("k"), "id")
    hot = spark.range(100, 140).select(F.lit(3).cast("bigint").alias("k"), "id")
    left = base.unionByName(hot) if hot_left else base
    right = (base.unionByName(hot) if hot_right else base).withColumnRenamed("id", "v")
    l, r = name(), name()
    tables.write_bucketed(left, l, "k", 4, path=str(tmp_path / "l"))
    tables.write_bucketed(right, r, "k", 4, path=str(tmp_path / "r"))
    assert rows(spark.table(l)) == rows(left) and rows(spark.table(r)) == rows(right)
    want = rows(left.join(right, "k"))
    large = large_groups(left.select("k").unionAll(right.select("k")), "k", 10)
    for keys in (None, large):
        assert rows(joins.bucket_join(spark, l, r, "k", hot=keys, salts=4)) == want


def test_three_bucketed_tables_and_a_pruned_partition(spark, tmp_path):
    fact = spark.range(400).select((F.col("id") % 50).alias("k"), "id")
    games = spark.range(50).select(F.col("id").alias("k"), (F.col("id") % 3).alias("y"))
    extra = spark.range(50).select(F.col("id").alias("k"), (F.col("id") * 3).alias("e"))
    names = [name() for _ in range(3)]
    for df, n in zip((games, fact, extra), names):
        tables.write_bucketed(df, n, "k", 4, partition_by="y" if df is games else None, path=str(tmp_path / n))
    out = joins.bucket_join(spark, names[0], names[1:], "k", where=F.col("y") == 1)
    assert rows(out.select("k", "id", "e")) == rows(games.where("y = 1").join(fact, "k").join(extra, "k").select("k", "id", "e"))
    with session_conf(spark, {"spark.sql.maxMetadataStringLength": "2000"}):
        p = plan(joins.bucket_join(spark, names[0], names[1:], "k", where=F.col("y") == 1))
    assert "Exchange" not in p and p.count("SortMergeJoin") == 2 and "PartitionFilters: [isnotnull(y" in p


def test_bucket_count():
    assert [tables.bucket_count(n, 1, 100) for n in (0, 100, 101, 400, 401)] == [1, 1, 2, 4, 8]


def test_a_fact_bucket_has_no_more_rows_in_larger_tables():
    for rows_ in (1, 600_000, 6_000_000, 36_000_000, 216_000_000, 10**10):
        n = storage.fact_buckets(rows_)
        assert n >= 4 and n & (n - 1) == 0 and rows_ / n <= 1_000_000


def test_periods_refuse_gaps_and_empty_reruns_empty_them(spark, tmp_path):
    t = name()

    def step(found):
        def run(prev, period):
            new = spark.createDataFrame(found, "k string").withColumn("period", F.lit(period))
            return new if prev is None else new.unionByName(prev.select("k", F.lit(period).alias("period")))
        return run

    tables.run_periods(spark, t, "period", [1, 2], step([("a",)]), str(tmp_path / "p"))
    with pytest.raises(ValueError, match="run 3 first"):
        tables.run_periods(spark, t, "period", [4], step([("b",)]))
    assert rows(spark.table(t).groupBy("period").count()) == [(1, 1), (2, 2)]
    tables.write_period(spark.createDataFrame([], "k string, period int"), t, "period", period=2)
    assert rows(spark.table(t)) == [("a", 1)]
    tables.run_periods(spark, t, "period", [2], step([("c",)]))
    assert rows(spark.table(t)) == [("a", 1), ("a", 2), ("c", 2)]


def test_clustered_files_and_report(spark, tmp_path):
    df = spark.range(20_000).select((F.col("id") % 7 == 0).cast("int").alias("d"), (F.col("id") * 7919 % 101).alias("h"), "id")
    paths = {n: str(tmp_path / n) for n in ("plain", "local", "global")}
    df.repartition(4).write.parquet(paths["plain"])
    tables.write_clustered(df, paths["local"], "d", ["d", "h"], n=4)
    tables.write_clustered(df, paths["global"], "d", ["d", "h"], n=4, global_sort=True)
    for f in glob.glob(paths["local"] + "/*.parquet"):
        got = [(r["d"], r["h"]) for r in spark.read.parquet(f).collect()]
        assert got == sorted(got)
    assert rows(spark.read.parquet(paths["local"])) == rows(df) == rows(spark.read.parquet(paths["global"]))
    report = {r["layout"]: (r["num_files"], r["size"]) for r in tables.layout_report(spark, paths).collect()}
    import os
    for n, p in paths.items():
        files = glob.glob(p + "/*.parquet")
        assert report[n] == (len(files), sum(map(os.path.getsize, files)))
    assert report["local"][1] < report["plain"][1]


def test_hot_value_is_split_over_files(spark, tmp_path):
    """One value with nearly all rows ends up in several files."""
    df = spark.range(300_000).select(F.lit("2024-01-01").alias("d"), F.xxhash64("id").alias("h"))
    with session_conf(spark, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "256KB"}):
        tables.write_clustered(df, str(tmp_path / "hot"), "d", ["d", "h"], n=4)
    assert len(glob.glob(str(tmp_path / "hot") + "/*.parquet")) > 2


def test_reused_releases(spark):
    df = spark.range(10).groupBy((F.col("id") % 2).alias("k")).count()
    with tables.reused(df) as kept:
        assert kept.is_cached and kept.count() == 2
    assert not df.is_cached


def test_shared_dir_follows_the_session(spark, tmp_path):
    with session_conf(spark, {}):
        assert shared_dir(spark, "x") != shared_dir(spark, "x")

    class Conf:
        def get(self, *_):
            return str(tmp_path)

    class Session:
        conf = Conf()

    assert shared_dir(Session(), "x").startswith(str(tmp_path) + "/strata/x-")


def test_salted_buckets_spread_a_hot_key(spark, tmp_path):
    """A third of all rows in one key: no exchange, the largest task reads less than three times the median, the result is that of a join."""
    n = 8
    fact = spark.range(60_000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 5000).cast("bigint").alias("k"), "id")
    dim = spark.range(5001).select(F.when(F.col("id") < 5000, F.col("id")).alias("k"), (F.col("id") * 2).alias("v"))
    extra = spark.range(4000).select(F.col("id").alias("k"), (F.col("id") * 3).alias("w"))
    fact = fact.unionByName(spark.createDataFrame([(None, -1)], "k bigint, id bigint"))
    salts = tables.materialize(tables.bucket_salts(large_groups(fact, "k", 60_000 // n), "k", n), name(), path=str(tmp_path / "s"))
    (hot,) = salts.collect()
    assert hot["k"] == 7 and len(set(hot["salts"])) == n
    f, d, e = name(), name(), name()
    tables.write_salted(fact, f, "k", n, salts, path=str(tmp_path / "f"))
    tables.write_salted(dim, d, "k", n, salts, copies=True, path=str(tmp_path / "d"))
    tables.write_salted(extra, e, "k", n, salts, copies=True, path=str(tmp_path / "e"))
    assert rows(spark.table(f).drop("_salt")) == rows(fact) and spark.table(d).count() == 5001 + n - 1
    for how in ("inner", "left"):
        assert rows(joins.salted_join(spark, f, [d, e], "k", how=how)) == rows(fact.join(dim, "k", how).join(extra, "k", how))
    out = joins.salted_join(spark, f, d, "k")
    assert "Exchange" not in plan(out) and "SortMergeJoin" in plan(out)
    per_task = sorted(r["count"] for r in out.groupBy(F.spark_partition_id().alias("task")).count().collect())
    assert len(per_task) == n and per_task[-1] < 3 * per_task[n // 2]
    # the same rows in plain buckets: one task has more than a third of all
    plain = name()
    tables.write_bucketed(fact, plain, "k", n, path=str(tmp_path / "p"))
    most = spark.table(plain).groupBy(F.pmod(F.hash("k"), F.lit(n))).count().agg(F.max("count")).first()[0]
    assert most > 3 * per_task[n // 2]


def test_salted_tables_without_hot_keys(spark, tmp_path):
    fact = spark.range(100).select((F.col("id") % 10).alias("k"), "id")
    none = spark.createDataFrame([], "k bigint, salts array<int>")
    f, d = name(), name()
    tables.write_salted(fact, f, "k", 4, none, path=str(tmp_path / "f"))
    tables.write_salted(fact.limit(0), d, "k", 4, none, copies=True, path=str(tmp_path / "d"))
    assert joins.salted_join(spark, f, d, "k").count() == 0 and joins.salted_join(spark, f, d, "k", how="left").count() == 100
    with pytest.raises(ValueError, match="inner or left"):
        joins.salted_join(spark, f, d, "k", how="full")
