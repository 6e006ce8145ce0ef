"""Near duplicates by an LSH forest: several sorted orders of MinHash signatures, neighbours by longest common prefix.

1. Documents with equal shingle sets are one class. A class has TREES signatures of DEPTH minima each.
2. In every tree the classes are sorted by their signature, by range over all partitions. Classes next to each other
   whose signatures share a prefix of BASE minima or more are candidates: in a dense region these are the ones with
   the longest common prefix. What they link joins most copies into components, however large a group is.
3. A region is all classes of a tree that share a prefix. Regions whose classes are one component need no more
   work. In the others every pair of different components is a candidate. How long the prefix is adapts to the
   region: it starts at BASE minima and grows where a region has more than REGION classes, so regions stay
   small where documents are dense and wide where they are few.
4. The classes outside a region's largest component, which are in every pair that is left, are compared with all classes of the
   region, in cells of at most BLOCK of either, by hashed bitmaps: their bit counts bound the overlap from above, so no
   link is ruled out. This is done twice: first only with the most promising class of a cell, which joins most
   of them, then with all; a pair that meets in several trees is a candidate in the first of them alone.

Candidates are verified on the full sets. Those of step 2 must first have sketches (one bit of each minimum) that allow a link; it rules out a
link with a chance of 1e-9, and what it rules out comes up again in step 3.
A pair at the bound shares a prefix of d minima in one tree with chance bound ** d: of two documents at 0.8 all TREES
trees miss each other with a chance of 1e-10 in a wide region (three minima), and of 6e-5 if in every tree the region was narrowed to all
DEPTH minima by classes that are no copies of them; copies of each other are linked before.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import packed, stored, unpacked
from strata.llm.components import connected_components
from strata.llm.jaccard import bitmap, fold, linked, overlap_bound, verified
from strata.llm.shingles import mix, shingle_sets, text_bytes
from strata.operators.guards import maybe_broadcast

# Trees, minima in a tree's signature, and the shortest prefix that makes candidates.
TREES, DEPTH, BASE = 32, 6, 3
# Classes of a region above which its prefix grows, and of either side of a cell.
REGION, BLOCK = 256, 1024
# Bits of a bitmap for each shingle, and the range of its width.
BITS_PER_SHINGLE, MIN_BITS, MAX_BITS = 8, 512, 1 << 17
# Bytes of a minimum in a signature.
WIDTH = 4
# Shingles whose hashes are permuted in one go.
SLICE = 1 << 16
SIGNED = "doc_id bigint, n bigint, digest binary, signature binary, s0 bigint, s1 bigint, s2 bigint"


def _functions() -> tuple[np.ndarray, np.ndarray]:
    """Multipliers (odd) and offsets of the hash functions, one for each minimum."""
    seeds = mix(np.arange(1, 2 * TREES * DEPTH + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return seeds[::2] | np.uint64(1), seeds[1::2]


def minima(sets: list[np.ndarray]) -> np.ndarray:
    """A row of minima for every set of hashes, none of them empty; the functions permute the 64-bit hashes, 32 bits of each result count."""
    a, b = _functions()
    out = np.full((len(sets), len(a)), np.uint32(0xFFFFFFFF))
    flat = np.concatenate(sets)
    ends = np.cumsum([len(s) for s in sets])
    starts = ends - [len(s) for s in sets]
    for low in range(0, len(flat), SLICE):
        part = flat[low:low + SLICE]
        rows = np.arange(np.searchsorted(ends, low, "right"), np.searchsorted(starts, low + len(part), "left"))
        at = np.maximum(starts[rows] - low, 0)
        for k in range(len(a)):
            # the upper half of a product mod 2**64 depends on all lower bits
            values = ((part * a[k] + b[k]) >> np.uint64(32)).astype(np.uint32)
            out[rows, k] = np.minimum(out[rows, k], np.minimum.reduceat(values, at))
    return out


def sketches(least: np.ndarray) -> np.ndarray:
    """One bit of every minimum, mixed so that it is even, as 64-bit integers."""
    bits = (mix(least.astype(np.uint64)) & np.uint64(1)).astype(np.uint8)
    return np.packbits(bits, axis=1, bitorder="little").view(np.int64)


def _signer(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, held, size = batch.column("doc_id").to_pylist(), [], 0
            for i, s in zip(ids, shingle_sets(*text_bytes(batch.column("text")), width)):
                held.append((i, s))
                size += len(s)
                if size > 4 * SLICE:
                    yield _signed(held)
                    held, size = [], 0
            if held:
                yield _signed(held)

    return run


def _signed(held: list[tuple]) -> pa.RecordBatch:
    full = [k for k, (_, s) in enumerate(held) if len(s)]
    values: list = [[None] * len(held) for _ in range(5)]
    if full:
        least = minima([held[k][1] for k in full])
        sketch = sketches(least)
        raw = least.astype(">u4").tobytes()  # big-endian: bytes sort as numbers do
        size = TREES * DEPTH * WIDTH
        for j, k in enumerate(full):
            values[0][k] = xxhash.xxh3_128_digest(held[k][1].tobytes())
            values[1][k] = raw[j * size:(j + 1) * size]
            for c in range(3):
                values[2 + c][k] = int(sketch[j, c])
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
    cols = [[i for i, _ in held], [len(s) for _, s in held], *values]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], ["doc_id", "n", "digest", "signature", "s0", "s1", "s2"])


NEIGHBOURS = "tree int, sig binary, class bigint, next bigint"


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows (tree, sig, class) that have a neighbour with a common prefix, and that neighbour where it comes after.

    The first and last row of a partition stay, as their neighbours may be in another one.
    """
    last = None  # the row before, with whether it has been passed on
    for batch in batches:
        if not batch.num_rows:
            continue
        tree = batch.column("tree").to_numpy()
        sig = np.frombuffer(b"".join(batch.column("sig").to_pylist()), f"S{BASE * WIDTH}").reshape(batch.num_rows, -1)[:, 0]
        # fixed-length byte strings drop trailing zero bytes on both sides of a comparison, so equality is that of all bytes
        same = (tree[1:] == tree[:-1]) & (sig[1:] == sig[:-1])
        joined = bool(last is not None and last["tree"] == tree[0] and last["head"] == sig[0])
        ids = batch.column("class").to_numpy()
        if last is not None and (joined or last["keep"]):
            yield _neighbour_rows([last["tree"]], [last["sig"]], [last["class"]], [int(ids[0]) if joined else None])
        before, after = np.r_[joined or last is None, same], np.r_[same, False]
        keep = np.flatnonzero((before | after)[:-1])
        if len(keep):
            part = batch.select(["tree", "sig", "class"]).take(pa.array(keep))
            following = pa.array(ids[keep + 1], pa.int64(), mask=~after[keep])
            yield pa.RecordBatch.from_arrays([*part.columns, following], ["tree", "sig", "class", "next"])
        last = {"tree": int(tree[-1]), "head": sig[-1], "sig": batch.column("sig")[-1].as_py(), "class": int(ids[-1]), "keep": bool(before[-1])}
    if last is not None:
        yield _neighbour_rows([last["tree"]], [last["sig"]], [last["class"]], [None])


def _neighbour_rows(*cols) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.binary(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], ["tree", "sig", "class", "next"])


def prefix(depth: Column) -> Column:
    return F.substring("sig", F.lit(1), WIDTH * depth)


def close(a: str, b: str, percent: int) -> Column:
    """Whether the sizes allow two sets (structs with n and the sketch) to link, and their sketches make it likely.

    A bit of the sketches differs with chance (1 - similarity) / 2; the limit is six deviations above the mean at the bound.
    """
    x, y = F.col(a), F.col(b)
    return (100 * F.least(x["n"], y["n"]) >= percent * F.greatest(x["n"], y["n"])) & (apart(x, y) <= sketch_limit(percent))


def sketch_limit(percent: int) -> int:
    bits, p = TREES * DEPTH, (1 - percent / 100) / 2
    return int(np.ceil(bits * p + 6 * np.sqrt(bits * p * (1 - p))))


def apart(x: Column, y: Column) -> Column:
    return sum((F.bit_count(x[s].bitwiseXOR(y[s])) for s in ("s1", "s2")), F.bit_count(x["s0"].bitwiseXOR(y["s0"])))


def _regions(rows: DataFrame) -> DataFrame:
    """The rows (tree, sig, class, comp) of regions with several components, with ``head``, the region's prefix, at its own depth.

    All prefixes are counted at once; a region is a prefix of at most REGION classes, or of full depth, of
    which no shorter prefix is one. Regions are joined with their rows as a stored table.
    """
    each = rows.select("tree", "sig", "class", "comp", F.explode(F.sequence(F.lit(BASE), F.lit(DEPTH))).alias("depth")).withColumn("head", prefix(F.col("depth")))
    groups = each.groupBy("tree", "depth", "head").agg(F.count(F.lit(1)).alias("members"), F.min("comp").alias("low"), F.max("comp").alias("high"))
    # a prefix of one class is no region, nor is one below it
    fits = groups.where("members > 1").where((F.col("members") <= REGION) | (F.col("depth") == DEPTH))
    fits = stored(fits.select("tree", "depth", "head", (F.col("low") != F.col("high")).alias("mixed")), "forest-prefixes")
    shorter = fits.select("tree", (F.col("depth") + 1).alias("depth"), F.col("head").alias("parent"))
    first = fits.where("mixed").withColumn("parent", F.substring("head", F.lit(1), WIDTH * (F.col("depth") - 1)))
    regions = stored(first.join(shorter.hint("merge"), ["tree", "depth", "parent"], "left_anti").select("tree", "depth", "head"), "forest-regions")
    return stored(each.join(regions.hint("merge"), ["tree", "depth", "head"]).select("tree", "head", "class", "comp"), "forest-mixed")


def _mapper(width: int):
    """The bitmap of every set, as wide as its size asks for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, held = [], 0
            for i, s in zip(batch.column("doc_id").to_pylist(), shingle_sets(*text_bytes(batch.column("text")), width)):
                if len(s):
                    bits = 1 << max(MIN_BITS.bit_length() - 1, min(MAX_BITS.bit_length() - 1, (BITS_PER_SHINGLE * len(s) - 1).bit_length()))
                    rows.append((i, len(s), bitmap(s, bits).tobytes()))
                    held += bits // 8
                if held > 2_000_000:
                    yield _maps(rows)
                    rows, held = [], 0
            yield _maps(rows)

    return run


def _maps(rows: list[tuple]) -> pa.RecordBatch:
    cols = zip(*rows) if rows else [[]] * 3
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, [pa.int64(), pa.int64(), pa.binary()])], ["class", "n", "map"])


def _cells(percent: int, best: bool):
    """Pairs (a, b) of each cell, whose rows come one after the other: classes to be compared (``minor``) and those they are compared with."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, current, found = [], None, set()
        for batch in batches:
            cell = batch.column("cell").to_numpy()
            cuts = [0, *(np.flatnonzero(cell[1:] != cell[:-1]) + 1).tolist(), len(cell)]
            for low, high in zip(cuts, cuts[1:]):
                if low == high:
                    continue
                if held and cell[low] != current:
                    found |= _cell_pairs(pa.Table.from_batches(held), percent, best)
                    held = []
                current = cell[low]
                held.append(batch.slice(low, high - low))
            if len(found) > 100_000:
                yield _pair_batch(found)
                found = set()
        if held:
            found |= _cell_pairs(pa.Table.from_batches(held), percent, best)
        yield _pair_batch(found)

    return run


def _pair_batch(pairs: set[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*sorted(pairs)) if pairs else ([], [])
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _cell_pairs(cell: pa.Table, percent: int, best: bool) -> set[tuple[int, int]]:
    minor, outside = (cell.column(c).to_numpy(zero_copy_only=False) for c in ("minor", "outside"))
    if minor.all() or not minor.any():
        return set()
    ids, comp, n = (cell.column(c).to_numpy() for c in ("class", "comp", "n"))
    tree = int(cell.column("tree")[0].as_py())
    regions = cell.column("regions").combine_chunks().flatten().to_numpy().reshape(len(ids), -1)[:, :tree]
    raw = cell.column("map").to_pylist()
    words = np.array([len(m) for m in raw]) // 8
    members = np.flatnonzero(~minor)
    stacks = {w: np.frombuffer(b"".join(raw[k] for k in members[words[members] == w]), np.uint64).reshape(-1, w) for w in np.unique(words[members])}
    found = set()
    for u in np.flatnonzero(minor):
        own = np.frombuffer(raw[u], np.uint64)[None]
        closest = None
        for w, stack in stacks.items():
            at = members[words[members] == w]
            # of two classes outside the largest component each is compared with the other: once is enough
            may = (comp[at] != comp[u]) & (ids[at] != ids[u]) & ~(outside[at] & (ids[at] < ids[u]))
            may &= (100 * n[at] >= percent * n[u]) & (100 * n[u] >= percent * n[at])
            if not best and tree:
                may &= ~((regions[at] == regions[u]) & (regions[u] != 0)).any(axis=1)
            some = np.flatnonzero(may)
            if not len(some):
                continue
            common = min(w, words[u])
            bound = overlap_bound(fold(own, common)[0], n[u], fold(stack[some], common), n[at][some])
            likely = np.flatnonzero(linked(n[u], n[at][some], bound, percent))
            if best and len(likely):
                share = bound[likely] / (n[u] + n[at][some][likely])
                top = share.argmax()
                if closest is None or share[top] > closest[0]:
                    closest = share[top], ids[at[some[likely[top]]]]
            elif not best:
                found |= {(int(min(ids[u], v)), int(max(ids[u], v))) for v in ids[at[some[likely]]]}
        if closest is not None:
            found.add((int(min(ids[u], closest[1])), int(max(ids[u], closest[1]))))
    return found


def _region_pairs(rows: DataFrame, maps: DataFrame, percent: int, best: bool) -> DataFrame:
    """Candidates (a, b) of different components in a region, from rows (tree, head, class, comp) and the classes' bitmaps (class, n, map).

    The classes outside a region's largest component and all of its classes are cut into blocks by hash;
    each block of the former meets each of the latter in a cell.
    """
    place = ["tree", "head"]
    sizes = rows.groupBy(*place, "comp").agg(F.count(F.lit(1)).alias("size"))
    regions = sizes.groupBy(*place).agg(F.max(F.struct("size", "comp")).alias("most"), F.sum("size").alias("members"))
    blocks = lambda x: F.ceil(x / BLOCK).cast("int")
    regions = stored(regions.select(*place, F.col("most.comp").alias("largest"), blocks(F.col("members")).alias("all_blocks"),
                                    blocks(F.col("members") - F.col("most.size")).alias("minor_blocks")), "forest-largest")
    # the regions of a class in all trees, 0 where it has none that counts: they tell in which tree a pair meets first
    key = F.when(F.xxhash64(*place) == 0, F.lit(1).cast("bigint")).otherwise(F.xxhash64(*place))
    by_tree = [F.coalesce(F.max(F.when(F.col("tree") == t, key)), F.lit(0).cast("bigint")) for t in range(TREES)]
    known = maps.join(rows.groupBy("class").agg(F.array(*by_tree).alias("regions")), "class")
    known = stored(known, "forest-classes-in-regions")
    marked = rows.join(regions.hint("merge"), place).withColumn("outside", F.col("comp") != F.col("largest"))
    part = lambda salt, n: F.pmod(F.xxhash64("class", F.lit(salt)), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    minors = marked.where("outside").withColumn("minor", F.lit(True)).withColumn("i", part(1, "minor_blocks")).withColumn("j", every("all_blocks"))
    others = marked.withColumn("minor", F.lit(False)).withColumn("i", every("minor_blocks")).withColumn("j", part(2, "all_blocks"))
    cells = minors.unionByName(others).select("class", "comp", "tree", "minor", "outside", F.xxhash64(*place, "i", "j").alias("cell"))
    # cells whose hashes are equal would be compared as one, which adds candidates and loses none
    filled = stored(cells, "forest-cells").join(known.hint("merge"), "class").repartition("cell").sortWithinPartitions("cell")
    return filled.select("cell", "tree", "class", "comp", "minor", "outside", "n", "regions", "map").mapInArrow(
        _cells(percent, best), "a bigint, b bigint").distinct()


def _likely(pairs: DataFrame, sketch: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sizes and sketches allow a link; a class id may have several sets."""
    own = F.struct("n", "s0", "s1", "s2")
    for side in ("a", "b"):
        pairs = pairs.join(sketch.select(F.col("class").alias(side), own.alias(f"of_{side}")), side)
    return pairs.where(close("of_a", "of_b", percent)).select("a", "b").distinct()


def near_duplicates(docs: DataFrame, percent: int = 80, width: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest id reachable by links, itself included) and ``kept`` of every row.

    Documents link when 100 * intersection >= percent * union of their sets of ``width``-word shingles, A-Z lower-cased;
    links are confirmed on the full sets. Fewer words are one shingle; null, empty and blank texts have none and link to
    nothing. One row of a component has doc_id = component_id and is ``kept``. Repeated ids count as one document with the
    links of each row. Rows with a null id are a component of their own, with null as its id, and kept. An empty table has no rows.
    """
    texts = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    signed = stored(texts.mapInArrow(_signer(width), SIGNED), "forest-signatures")
    full = signed.where("n > 0 and doc_id is not null")
    classes = stored(full.groupBy("digest").agg(F.min("doc_id").alias("class")), "forest-classes")
    # one row of each class speaks for it; of repeated rows any, as they are equal
    heads = full.join(classes.select("digest", F.col("class").alias("doc_id")).hint("merge"), ["digest", "doc_id"], "left_semi")
    sketch = stored(heads.select(F.col("doc_id").alias("class"), "n", "s0", "s1", "s2").distinct(), "forest-sketches")
    step = F.lit(DEPTH * WIDTH)
    trees = heads.select(F.col("doc_id").alias("class"), "signature", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree")).select(
        "tree", F.substring("signature", F.col("tree") * step + 1, step).alias("sig"), "class")
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    ordered = trees.repartitionByRange(parts, "tree", "sig", "class").sortWithinPartitions("tree", "sig", "class")
    crowd = stored(ordered.mapInArrow(_neighbours, NEIGHBOURS), "forest-neighbours")

    next_to = crowd.where("next <> class").select(F.least("class", "next").alias("a"), F.greatest("class", "next").alias("b")).distinct()
    links = verified(_likely(next_to, sketch, percent), texts, percent, width)
    # an id with several texts has the links of each
    by_doc = full.select("doc_id", "digest").join(classes.hint("merge"), "digest").groupBy("doc_id").agg(F.collect_set("class").alias("of"))
    several = by_doc.where("size(of) > 1").select(F.array_min("of").alias("a"), F.explode("of").alias("b")).where("a <> b")
    links = stored(links.unionByName(several), "forest-links")
    comps = connected_components(links)
    rows = stored(crowd.select("tree", "sig", "class").distinct(), "forest-crowd")
    maps = None
    for best in (True, False):
        of = comps.select(F.col("node").alias("class"), "comp")
        regions = _regions(rows.join(of, "class", "left").withColumn("comp", F.coalesce("comp", "class")))
        if regions.isEmpty():
            break
        if maps is None:  # no class comes into a mixed region later, as components only grow
            wanted = maybe_broadcast(regions.select(F.col("class").alias("doc_id")).distinct())
            maps = stored(texts.join(wanted, "doc_id", "left_semi").mapInArrow(_mapper(width), "class bigint, n bigint, map binary").distinct(), "forest-maps")
        more = verified(_region_pairs(regions, maps, percent, best), texts, percent, width)
        if not more.isEmpty():
            # components stand for the links that made them: few rounds join what is new
            known = comps.where("node <> comp").select(F.col("node").alias("a"), F.col("comp").alias("b"))
            comps = connected_components(known.unionByName(more))

    by_class = stored(classes.join(comps, classes["class"] == comps["node"], "left").select("digest", F.coalesce("comp", "class").alias("found")), "forest-found")
    found = signed.select("doc_id", "n", "digest").join(by_class.hint("merge"), "digest", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("found", "doc_id"))
    return found.select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
        (F.col("doc_id").isNull() | (component == F.col("doc_id"))).alias("kept"))


def keep_one(docs: DataFrame, percent: int = 80, width: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, less those that are near duplicates of one with a smaller id. Rows of one id stay or go together."""
    groups = near_duplicates(docs, percent, width, id_col, text_col)
    gone = maybe_broadcast(stored(groups.where("not kept").select(F.col("doc_id").alias("id")).distinct(), "forest-gone"))
    return unpacked(packed(docs, id=F.col(f"`{id_col}`").cast("bigint")).join(gone, "id", "left_anti"))
