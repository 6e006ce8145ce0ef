"""Mixing sources to target weights by weighted fair queueing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import count_words, packed, stored

# Parts of each source's queue that are summed apart, named by this many hex digits of the shuffle key.
BLOCK_DIGITS = 3
# Ranges into which the virtual time is divided in each step of the search for the cut.
RANGES = 4096
# The last range is ordered row by row when it holds no more copies than this.
EXACT_ROWS = 100_000


def source_key(source: Column) -> Column:
    """A join key of the source that is never null."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def shuffle_key(doc_id: Column, text: Column, seed: str) -> Column:
    """Fixes a random order: by the id, and by the text where that is null."""
    name = F.coalesce(doc_id.cast("string"), F.md5(text.cast("binary")), F.lit(""))
    return F.md5(F.concat(F.lit(seed + ":"), name).cast("binary"))


def queue_rows(docs: DataFrame, seed: str, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """id, src, size in words, shuffle key and block of every row, and the row itself."""
    h = shuffle_key(F.col(id_col), F.col(text_col), seed)
    return packed(
        docs, id=F.col(id_col), src=source_key(F.col(source_col)), size=count_words(F.col(text_col)), h=h,
        block=F.substring(h, 1, BLOCK_DIGITS))


def cyclic_weights(sizes: DataFrame, weights: list[int]) -> DataFrame:
    """src, source_size, weight: the sources by code point, null last, take the weights in turn.

    Numbers the list of sources, of which there is one row each, in one task.
    """
    order = Window.orderBy(F.col("src") == "", "src")
    turn = (F.row_number().over(order) - 1) % len(weights)
    return sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int")))


def fill_targets(sources: DataFrame, budget: float, most: int) -> DataFrame:
    """Add ``target``: the budget shared by weight, no source above ``most`` times its size.

    What capped sources leave is shared again by weight until no other source is above
    its cap. Only the level (words per unit of weight) is kept on the driver.
    """
    sources = stored(sources.withColumn("cap", (F.col("source_size") * most).cast("double")), "sources")
    level, above = 0.0, -1
    while True:
        full = F.col("cap") <= F.lit(level) * F.col("weight")
        n, caps, rest = sources.agg(
            F.count_if(full), F.coalesce(F.sum(F.when(full, F.col("cap"))), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0))).first()
        if n == above or rest == 0:
            return sources.withColumn("target", F.when(full, F.col("cap")).otherwise(F.lit(level) * F.col("weight")))
        above, level = n, (budget - caps) / rest


def _queued(rows: DataFrame, blocks: DataFrame) -> DataFrame:
    """Add the virtual finish time of each row's first and later copies: words so far in its source over the target."""
    inside = Window.partitionBy("src", "block").orderBy("h", "id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = rows.withColumn("run", F.sum("size").over(inside))
    return run.join(blocks, ["src", "block"]).withColumn("cum", F.col("before") + F.col("run"))


def _finish(epoch: int) -> Column:
    """Null where the row can never be taken: no words, or a source without a share."""
    words = F.col("cum") + F.col("source_size") * epoch
    return F.when((F.col("size") > 0) & (F.col("target") > 0), words / F.col("target"))


def _taken(epoch: int, cut: tuple[float, str, int] | None) -> Column:
    """Whether the copy comes before the cut in the order (finish time, source, epoch)."""
    t = _finish(epoch)
    if cut is None:
        return F.lit(False)
    finish, src, last = cut
    return F.coalesce((t < finish) | ((t == finish) & ((F.col("src") < src) | ((F.col("src") == src) & F.lit(epoch <= last)))), F.lit(False))


def find_cut(copies: DataFrame, budget: float) -> tuple[float, str, int] | None:
    """The last copy, as (t, src, epoch), of the globally ordered copies (t, src, epoch, size) that fits the budget.

    The copies are sorted into ranges of virtual time, which hold about the same number
    of words each as every source fills its target at the same speed; words are summed per
    range, and only the range in which the budget ends is divided again, in the end row
    by row. Copies of one and the same time stay together: that is one per source at most.
    """
    copies = copies.where("t is not null")
    low, high = copies.agg(F.min("t"), F.max("t")).first()
    if low is None:
        return None
    before = 0
    while True:
        width = (high - low) / RANGES
        if width > 0:
            place = F.least(F.floor((F.col("t") - low) / width), F.lit(RANGES - 1))
        else:
            place = F.lit(0)
        ranges = copies.where(F.col("t").between(low, high)).groupBy(place.cast("int").alias("place")).agg(
            F.sum("size").alias("words"), F.count(F.lit(1)).alias("n"), F.min("t").alias("low"), F.max("t").alias("high"))
        total = F.sum("words").over(Window.orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow))
        hit = ranges.withColumn("total", total).where(F.col("total") + F.lit(before) > budget).orderBy("place").first()
        if hit is None:
            last = copies.orderBy(F.desc("t"), F.desc("src"), F.desc("epoch")).first()
            return last["t"], last["src"], last["epoch"]
        before += hit["total"] - hit["words"]
        start, low, high = low, hit["low"], hit["high"]
        if hit["n"] <= EXACT_ROWS or low == high:
            break
    order = Window.orderBy("t", "src", "epoch")
    inside = copies.where(F.col("t").between(low, high)).withColumn("total", F.sum("size").over(order) + F.lit(before))
    last = inside.where(F.col("total") <= budget).orderBy(F.desc("t"), F.desc("src"), F.desc("epoch")).first()
    if last is None:
        last = copies.where(F.col("t") < low).orderBy(F.desc("t"), F.desc("src"), F.desc("epoch")).first()
    return None if last is None else (last["t"], last["src"], last["epoch"])


def mix(docs: DataFrame, weights, share: float = 1.5, most: int = 2, seed: str = "mix", id_col: str = "doc_id",
        source_col: str = "source", text_col: str = "text") -> DataFrame:
    """How often each row enters the mix: ``row``, id, src, size, source_size, target, ``copies``.

    ``weights`` turns the table (src, source_size) into (src, source_size, weight). The mix
    has ``share`` times all words. Each source queues its rows in a random order that the
    seed and the id fix, ``most`` times over; a copy's virtual finish time is the source's
    words up to and including it over the source's target; all copies are ordered by that
    time and cut where the budget ends. So every source comes within its longest documents
    of its target.

    Null or empty text has size 0 and is never taken. Null is a source of its own. Repeated
    rows queue one by one. Empty tables give an empty mix. All columns are kept in ``row``.

    A hot source is summed in blocks by its shuffle key, and rows only meet the totals of
    their block, so no task holds a source; no step sorts all rows in one task.
    """
    rows = queue_rows(docs, seed, id_col, source_col, text_col)
    narrow = stored(rows.drop("row"), "queue")
    parts = stored(narrow.groupBy("src", "block").agg(F.sum("size").alias("words")), "queue-blocks")
    sizes = parts.groupBy("src").agg(F.sum("words").alias("source_size"))
    total = sizes.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    budget = share * total
    targets = fill_targets(weights(sizes), budget, most).select("src", "source_size", "target")
    earlier = Window.partitionBy("src").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = stored(
        parts.join(targets, "src").select(
            "src", "block", "source_size", "target", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("before")),
        "queue-starts")
    each = F.explode(F.array(*[F.struct(_finish(e).alias("t"), F.lit(e).alias("epoch")) for e in range(most)]))
    copies = stored(_queued(narrow, blocks).select("src", "size", each.alias("copy")).select("src", "size", "copy.t", "copy.epoch"), "copies")
    cut = find_cut(copies, budget)
    copies = sum((_taken(e, cut).cast("int") for e in range(1, most)), _taken(0, cut).cast("int"))
    return _queued(rows, blocks).select("row", "id", "src", "size", "source_size", "target", copies.alias("copies"))


def mixed_documents(docs: DataFrame, weights, **options) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken, with the same columns."""
    taken = mix(docs, weights, **options).where("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")
