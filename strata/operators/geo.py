"""IP ranges to places: a prefix equi-join instead of a nested-loop range join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.columns import ip_number
from strata.operators.guards import BROADCAST_MAX_BYTES, BROADCAST_MAX_ROWS, maybe_broadcast, require

PLACE = ["country", "state", "city"]


def _blocks(lo: str, hi: str, bits: int) -> Column:
    """The aligned blocks (level, place) that make up the numbers from lo to hi: [place * 2**level, (place + 1) * 2**level).

    ``bits`` is the highest level. At each level a range adds its first block if that is odd and its last if that is even, as
    pairs of blocks are one of the level above: two a level at most.
    """
    def at(k):
        first = F.call_function("shiftright", F.col(lo) + F.call_function("shiftleft", F.lit(1).cast("bigint"), k) - 1, k)
        end = F.call_function("shiftright", F.col(hi) + 1, k)
        block = lambda use, place: F.when((first < end) & use, F.struct(k.alias("level"), place.alias("place")))
        return F.array(block((first % 2 == 1) | (k == bits), first), block((end % 2 == 1) & (k < bits), end - 1))

    return F.filter(F.flatten(F.transform(F.sequence(F.lit(0), F.lit(bits)), at)), lambda b: b.isNotNull())


def geo_segments(ranges: DataFrame, prefix_bits: int = 16) -> DataFrame:
    """Cut ranges (lo, hi, country, state, city) at prefix edges into disjoint segments.

    Where ranges overlap the narrowest one wins (then the lowest start, then the
    place in alphabetical order); only prefixes with an overlap are cut at every
    edge. Disjoint ranges yield at most one segment per range plus one per prefix.
    Each segment carries the prefix length it was cut with.

    A piece between two edges finds its range by equality: ranges are taken apart into aligned blocks, of which only the best range
    of each is kept, and the piece looks up the blocks that hold its start, one at each level. So the work
    grows with ranges times levels, however many ranges overlap or lie within one prefix.
    """
    shift = 32 - prefix_bits
    size = 1 << shift
    each = ranges.distinct().withColumn("prefix", F.explode(F.sequence(F.shiftright("lo", shift), F.shiftright("hi", shift))))
    each = each.withColumns({
        "low": F.greatest(F.col("lo"), F.col("prefix") * F.lit(size)),
        "high": F.least(F.col("hi"), F.col("prefix") * F.lit(size) + F.lit(size - 1)),
        "width": F.col("hi") - F.col("lo"),
    })
    w = Window.partitionBy("prefix")
    before = F.max("high").over(w.orderBy("low").rowsBetween(Window.unboundedPreceding, -1))
    each = each.withColumn("_meets", F.coalesce((before >= F.col("low")).cast("int"), F.lit(0)))
    each = each.withColumn("_overlap", F.max("_meets").over(w))
    disjoint = each.where("_overlap = 0").select("prefix", F.col("low").alias("seg_lo"), F.col("high").alias("seg_hi"), *PLACE)

    # a piece between two neighbouring edges of a prefix belongs to the narrowest range that covers it
    crowded = each.where("_overlap = 1")
    edges = crowded.select("prefix", F.explode(F.array("low", F.col("high") + 1)).alias("seg_lo")).distinct()
    pieces = edges.withColumn("seg_hi", F.lead("seg_lo").over(Window.partitionBy("prefix").orderBy("seg_lo")) - 1).where("seg_hi is not null")
    held = crowded.select(F.struct("width", "lo", *PLACE).alias("_range"), F.explode(_blocks("low", "high", shift)).alias("_b"))
    best = held.groupBy(F.col("_b.level").alias("_level"), F.col("_b.place").alias("_place")).agg(F.min("_range").alias("_range"))
    levels = F.explode(F.sequence(F.lit(0), F.lit(shift)))
    looked = pieces.withColumn("_level", levels).withColumn("_place", F.call_function("shiftright", F.col("seg_lo"), F.col("_level")))
    cut = looked.join(best, ["_level", "_place"]).groupBy("prefix", "seg_lo", "seg_hi").agg(F.min("_range").alias("_r"))
    cut = cut.select("prefix", "seg_lo", "seg_hi", *[F.col("_r")[p].alias(p) for p in PLACE])
    return disjoint.unionByName(cut).withColumn("prefix_bits", F.lit(prefix_bits))


def _few_segments(ranges: DataFrame, prefix_bits: int) -> bool:
    """Whether the segments stay below the broadcast limits: every (range, prefix) piece adds at most two."""
    shift = 32 - prefix_bits
    pieces, text = ranges.agg(
        F.sum(F.shiftright("hi", shift) - F.shiftright("lo", shift) + 1), F.max(F.octet_length(F.concat_ws("", *PLACE)))).first()
    most = 2 * (pieces or 0)
    return most <= BROADCAST_MAX_ROWS and most * (32 + (text or 0)) <= BROADCAST_MAX_BYTES


def geo_enrich(df: DataFrame, ip: str, ranges: DataFrame, prefix_bits: int = 16, name: str = "geodata") -> DataFrame:
    """Add the place of an IP address as JSON text; ``{}`` where no range holds it.

    ``ranges`` are raw ranges or ``geo_segments`` of the same prefix length (keep
    these as a table where they serve many batches of a stream). One row in, one
    row out. The segments are broadcast only after their size was measured.
    """
    if "seg_lo" in ranges.columns:
        matching = require(ranges, F.col("prefix_bits") == prefix_bits, f"the segments were not cut with {prefix_bits} prefix bits")
        segments = maybe_broadcast(matching)
    else:
        segments = geo_segments(ranges, prefix_bits)
        segments = F.broadcast(segments) if _few_segments(ranges, prefix_bits) else segments
    segments = segments.withColumnRenamed("prefix", "_prefix")
    rows = df.withColumn("_ip", ip_number(ip)).withColumn("_prefix", F.shiftright("_ip", 32 - prefix_bits))
    on = (rows["_prefix"] == segments["_prefix"]) & rows["_ip"].between(segments["seg_lo"], segments["seg_hi"])
    place = F.to_json(F.struct(*[F.coalesce(segments[p], F.lit("")).alias(p) for p in PLACE]))
    joined = rows.join(segments, on, "left")
    return joined.select(*[rows[c] for c in df.columns], F.when(segments["seg_lo"].isNull(), F.lit("{}")).otherwise(place).alias(name))
