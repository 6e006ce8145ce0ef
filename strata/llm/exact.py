"""Exact deduplication against a persistent digest index, bucketed and sorted by the digest."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import ascii_lower, packed, stored, unpacked

ENTRY = "digest binary, keep_id bigint, keep_row bigint, group_size bigint, batch string"


def digest(text: Column) -> Column:
    """SHA-256 (hex) of the text with A-Z lower-cased; null counts as empty."""
    return F.sha2(ascii_lower(F.coalesce(text, F.lit(""))).cast("binary"), 256)


def open_index(spark, name: str, buckets: int | None = None) -> DataFrame:
    """The digest index ``name``, created empty where it is missing.

    ``buckets`` is fixed when the table is made; by default it is the session's
    number of shuffle partitions, so that a batch is written without a shuffle of
    its own. Appended batches add one sorted file per bucket.
    """
    if not spark.catalog.tableExists(name):
        n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        spark.sql(f"create table {name} ({ENTRY}) using parquet clustered by (digest) sorted by (digest) into {n} buckets")
    return spark.table(name)


def _buckets(spark, name: str) -> int:
    row = spark.sql(f"describe extended {name}").where("col_name = 'Num Buckets'").first()
    return int(row["data_type"])


def dedupe_batch(docs: DataFrame, index: str, id_col: str = "doc_id", text_col: str = "text", buckets: int | None = None) -> DataFrame:
    """Decide for each row of a batch whether it stays, and append the new digests to the index.

    Returns one row per row of ``docs``: doc_id, digest (binary), keep_id, group_size,
    kept. Of equal texts that the index does not hold the row with the largest id
    stays; of rows that also share the id (or all have a null id) exactly one. Texts
    that an earlier batch added are dropped and report the id kept then, and the group
    size of that batch. Null text counts as empty. An empty batch adds nothing.

    The batch is aggregated by digest before any join, so a group of copies, however
    large, is one row per task. Only digests are shuffled, never texts. New groups are
    found by a sort-merge anti-join: the index side is read in bucket order. Groups meet the
    index once more for what it says of them, one row each; the verdicts are stored, and the rows are joined to these
    and not to the index, whose buckets would hold all rows of a digest in one task: two plain
    tables are shuffled, and adaptive execution splits the rows of a large group.
    """
    spark = docs.sparkSession
    open_index(spark, index, buckets)
    batch = uuid.uuid4().hex
    rows = stored(
        docs.select(
            F.col(id_col).cast("bigint").alias("doc_id"), F.unhex(digest(F.col(text_col))).alias("digest"),
            F.monotonically_increasing_id().alias("row")),
        "digests")
    last = F.max(F.struct("doc_id", "row"))
    # stored, as the optimizer would else join all rows of a group before it aggregates them
    groups = stored(rows.groupBy("digest").agg(last.alias("last"), F.count(F.lit(1)).alias("group_size")), "digest-groups")
    new = groups.join(spark.table(index).select("digest").hint("merge"), "digest", "left_anti").select(
        "digest", F.col("last.doc_id").alias("keep_id"), F.col("last.row").alias("keep_row"), "group_size",
        F.lit(batch).alias("batch"))
    # appended under the batch's name: a repeated task replaces its files, and a failed job commits none
    new.write.format("parquet").bucketBy(_buckets(spark, index), "digest").sortBy("digest").mode("append").saveAsTable(index)
    verdicts = stored(groups.select("digest").join(spark.table(index).hint("merge"), "digest").select(
        "digest", "keep_id", "group_size", F.when(F.col("batch") == batch, F.col("keep_row")).alias("keep_row")), "digest-verdicts")
    kept = F.coalesce(F.col("row") == F.col("keep_row"), F.lit(False))
    return rows.join(verdicts.hint("merge"), "digest").select("doc_id", "digest", "keep_id", "group_size", kept.alias("kept"))


def drop_copies(docs: DataFrame, index: str, id_col: str = "doc_id", text_col: str = "text", buckets: int | None = None) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns, by the rule of ``dedupe_batch``.

    Texts are shuffled once, by digest and id together, so that a large group of copies
    spreads over all tasks; repeated rows are merged before the shuffle.
    """
    keepers = dedupe_batch(docs, index, id_col, text_col, buckets).where("kept").select(_key(F.hex("digest"), F.col("doc_id")).alias("key"))
    keyed = packed(docs, key=_key(F.upper(digest(F.col(text_col))), F.col(id_col).cast("bigint")))
    once = keyed.groupBy("key").agg(F.first("row").alias("row"))
    # an inner join with distinct keys: a semi-join would be moved below the aggregate that merges repeated rows
    return unpacked(once.join(keepers.distinct().hint("merge"), "key"))


def _key(hex_digest: Column, doc_id: Column) -> Column:
    return F.concat_ws(":", hex_digest, doc_id.cast("string"))


def fresh_index(label: str = "digest_index") -> str:
    """A table name that no other run uses."""
    return f"strata_{label}_{uuid.uuid4().hex[:12]}"
