"""Exact n-gram Jaccard self-join: size-banded tiles, hashed bitmaps, sorted-array intersection.

Two documents link when the Jaccard similarity of their shingle sets is at least a bound.
The result keeps every link's effect (the components) without listing all pairs of a group.

1. Documents with equal sets are one class, represented by the smallest id.
2. Two linked classes share one of the first n - ceil(bound * n) + 1 shingles of either set, in any
   fixed order of all shingles. The order takes frequent shingles last, so a passage that many
   documents share brings few of them together. Shingles are frequent above a share of all
   shingles, which bounds their list; the list only fixes the order. Within it shingles are ordered by hash, so the
   first shared one comes early: the search ends where the chance that it is still to come is
   below ``miss`` (1e-18 a pair, less than that of two equal hashes); ``miss=0`` goes to the last.
3. Classes that share such a shingle and lie in the same or the next band of sizes are
   candidates. Each is first compared with one class only, the smallest id of its shingle and band.
4. Shingles whose classes are one component by then need no more work, however many they are. The
   others are compared in tiles: blocks of classes of one shingle and neighbouring bands,
   every pair of different components by its bitmaps, whose bit counts bound the overlap from above. This is done
   twice: first each class is paired with the most promising one of another component, which joins many,
   then the classes that have any possible partner left in another component are kept.
5. What passes the bitmaps is decided by intersecting the sorted arrays: pairs one by one, the classes that the tiles
   kept all together in their tile. A tile gives the links that join its components and no
   others, so that its rows never outnumber its classes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import packed, stored, unpacked
from strata.llm.components import connected_components
from strata.llm.shingles import shingle_sets, text_bytes
from strata.operators.guards import maybe_broadcast

# Shingles are frequent above this share of all shingles (so there are at most a million), and this count.
FREQUENT_SHARE, FREQUENT_COUNT = 1e-6, 64
# Shingles counted together in a task; those found less often than COUNT_LEAST in such a chunk are not passed on.
COUNT_CHUNK, COUNT_LEAST = 2_000_000, 6
# Classes in a block of a tile, and shingles of their sets together.
BLOCK, BLOCK_SHINGLES = 8_000, 1_000_000
# Bits of a bitmap for each shingle of the largest set of a band, and the range of its width.
BITS_PER_SHINGLE, MIN_BITS, MAX_BITS = 4, 256, 1 << 18


def band_of(n: Column, percent: int) -> Column:
    """Bands so wide that sets of which one has at least ``percent`` of the other's size are in the same or in neighbouring ones."""
    return F.floor(F.log(n.cast("double")) / math.log(100 / percent * 1.001)).cast("int")


def prefix_length(n: int, rare: int, percent: int, miss: float) -> int:
    """How many shingles of a set of ``n``, ``rare`` of which are not frequent, are searched.

    A partner lacks ``lacking`` of them at most. Were all these rare ones, k rare shingles in the order of
    their hashes would all be lacking with a chance below (lacking / rare) ** k.
    """
    lacking = n - -(-percent * n // 100)
    if miss > 0 and 0 < lacking < rare:
        return min(lacking + 1, math.ceil(math.log(miss) / math.log(lacking / rare)))
    return lacking + 1


def linked(n_a, n_b, overlap, percent: int):
    """Whether sets of these sizes and (at most) this overlap reach the bound; works on numbers, arrays and columns."""
    return (100 + percent) * overlap >= percent * (n_a + n_b)


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))


def _sets_of(batches: Iterator[pa.RecordBatch], width: int):
    for batch in batches:
        ids = batch.column("doc_id").to_pylist()
        yield from zip(ids, shingle_sets(*text_bytes(batch.column("text")), width))


def _profiler(width: int):
    """Rows of two kinds: one per document (size and digest of its set), and shingles that are frequent in a chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs, chunk, held = [], [], 0
        for doc_id, s in _sets_of(batches, width):
            docs.append((doc_id, len(s), xxhash.xxh3_128_digest(s.tobytes()), None, None))
            chunk.append(s)
            held += len(s)
            if held >= COUNT_CHUNK:
                yield _profile(docs + _frequent(chunk))
                docs, chunk, held = [], [], 0
        yield _profile(docs + _frequent(chunk))

    return run


def _frequent(chunk: list[np.ndarray]):
    tokens, counts = np.unique(np.concatenate(chunk), return_counts=True) if chunk else (np.zeros(0, np.uint64), np.zeros(0, int))
    of = counts >= COUNT_LEAST
    return [(None, None, None, t, c) for t, c in zip(tokens[of].view(np.int64).tolist(), counts[of].tolist())]


PROFILE = "doc_id bigint, n bigint, digest binary, token bigint, count bigint"


def _profile(rows):
    cols = list(zip(*rows)) if rows else [[]] * 5
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], ["doc_id", "n", "digest", "token", "count"])


def _prefixes(width: int, percent: int, frequent, miss: float):
    """(token, doc_id) for the first shingles of every set, frequent ones last."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        late = frequent.value
        tokens, ids, held = [], [], 0
        for doc_id, s in _sets_of(batches, width):
            if not len(s):
                continue
            rare = len(s)
            if len(late):
                of = late[np.minimum(np.searchsorted(late, s), len(late) - 1)] == s
                if of.any():
                    s, rare = np.concatenate([s[~of], s[of]]), len(s) - int(of.sum())
            first = prefix_length(len(s), rare, percent, miss)
            tokens.append(s[:first])
            ids.append((doc_id, first))
            held += first
            if held > 500_000:
                yield _token_batch(tokens, ids)
                tokens, ids, held = [], [], 0
        if ids:
            yield _token_batch(tokens, ids)

    return run


def _token_batch(tokens, ids):
    docs = np.repeat(np.array([i for i, _ in ids], np.int64), [n for _, n in ids])
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(tokens).view(np.int64)), pa.array(docs)], ["token", "doc_id"])


def _bits(n: int, percent: int) -> int:
    """Width of the bitmap of a set: by the largest size of its band, so that neighbouring bands differ by a factor of two at most."""
    step = math.log(100 / percent * 1.001)
    top = math.exp(step * (math.floor(math.log(n) / step) + 1))
    return int(min(max(2 ** math.ceil(math.log2(BITS_PER_SHINGLE * top)), MIN_BITS), MAX_BITS))


def bitmap(s: np.ndarray, bits: int) -> np.ndarray:
    flags = np.zeros(bits, np.uint8)
    flags[(s & np.uint64(bits - 1)).astype(np.int64)] = 1
    return np.packbits(flags, bitorder="little").view(np.uint64)


def fold(maps: np.ndarray, words: int) -> np.ndarray:
    """Bitmaps (a row each) cut to ``words`` words: a bit is set where any bit of its place modulo the width is."""
    return np.bitwise_or.reduce(maps.reshape(len(maps), -1, words), axis=1)


def overlap_bound(a: np.ndarray, n_a: int, maps: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Upper bounds of the overlap of one set with many: each bit that only one of two maps has stands for a shingle the other lacks."""
    only_a = np.bitwise_count(a & ~maps).sum(axis=1, dtype=np.int64)
    only_b = np.bitwise_count(~a & maps).sum(axis=1, dtype=np.int64)
    return np.minimum(n_a - only_a, sizes - only_b)


MAPS, SETS = "doc_id bigint, n bigint, map binary", "doc_id bigint, n bigint, hashes binary"


def _set_rows(width: int, percent: int, name: str):
    """Size and bitmap (``map``) or sorted array (``hashes``) of every set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for doc_id, s in _sets_of(batches, width):
            if len(s):
                rows.append((doc_id, len(s), (bitmap(s, _bits(len(s), percent)) if name == "map" else s).tobytes()))
                held += len(rows[-1][2])
            if held > 2_000_000:
                yield _set_batch(rows, name)
                rows, held = [], 0
        if rows:
            yield _set_batch(rows, name)

    return run


def _set_batch(rows, name):
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(zip(*rows), [pa.int64(), pa.int64(), pa.binary()])], ["doc_id", "n", name])


def _possible(percent: int):
    """Keeps the pairs (a, b) whose bitmaps allow a link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for n_a, n_b, a, b in zip(*(batch.column(c).to_pylist() for c in ("n_a", "n_b", "map_a", "map_b"))):
                words = min(len(a), len(b)) // 8
                a, b = (fold(np.frombuffer(m, np.uint64)[None], words) for m in (a, b))
                keep.append(bool(linked(n_a, n_b, overlap_bound(a[0], n_a, b, np.array([n_b]))[0], percent)))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _certain(percent: int):
    """Keeps the pairs (a, b) whose sorted arrays have the overlap that links them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for a, b in zip(batch.column("hashes_a").to_pylist(), batch.column("hashes_b").to_pylist()):
                a, b = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
                small, large = (a, b) if len(a) < len(b) else (b, a)
                at = np.minimum(np.searchsorted(large, small), len(large) - 1)
                keep.append(bool(linked(len(a), len(b), int((large[at] == small).sum()), percent)))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _with(pairs: DataFrame, sets: DataFrame, value: str) -> DataFrame:
    for side in ("a", "b"):
        own = sets.select(F.col("doc_id").alias(side), F.col("n").alias(f"n_{side}"), F.col(value).alias(f"{value}_{side}"))
        pairs = pairs.join(own, side)
    return pairs


def possible(pairs: DataFrame, maps: DataFrame, percent: int) -> DataFrame:
    """The candidate pairs (a, b) that sizes and bitmaps allow."""
    sized = _with(pairs, maps, "map").where((100 * F.least("n_a", "n_b")) >= percent * F.greatest("n_a", "n_b"))
    return sized.mapInArrow(_possible(percent), "a bigint, b bigint")


def verified(pairs: DataFrame, texts: DataFrame, percent: int, width: int) -> DataFrame:
    """The linked ones of the possible pairs; arrays are made for the texts in them alone."""
    pairs = stored(pairs, "possible-pairs")
    sets = _arrays(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")), texts, percent, width)
    return stored(_with(pairs, sets, "hashes").mapInArrow(_certain(percent), "a bigint, b bigint"), "linked-pairs")


def _arrays(ids: DataFrame, texts: DataFrame, percent: int, width: int) -> DataFrame:
    """The sorted arrays of the sets of these ids (doc_id, repeated or not)."""
    own = texts.join(maybe_broadcast(ids.distinct()), "doc_id", "left_semi")
    return stored(own.mapInArrow(_set_rows(width, percent, "hashes"), SETS), "pair-sets")


def _partners(cell: pa.Table, percent: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Rows of one cell (block i against block j of a tile), the rows of other components that the bitmaps allow each, and how alike they may be.

    Of two classes of different components one at least is outside the cell's largest component, so
    only those classes are compared with the rest.
    """
    comp, n = (cell.column(c).to_numpy() for c in ("comp", "n"))
    own, in_i, in_j = (cell.column(c).to_numpy(zero_copy_only=False) for c in ("own", "in_i", "in_j"))
    maps = cell.column("map").to_pylist()
    sizes = np.array([len(m) for m in maps])
    apart = _apart(comp)
    for width in np.unique(sizes) if apart.any() else ():
        # every pair is met at the smaller width of the two
        at = np.flatnonzero(sizes >= width)
        small = sizes[at] == width
        rows = np.stack([fold(np.frombuffer(maps[k], np.uint64)[None], width // 8)[0] for k in at])
        for r in np.flatnonzero(apart[at]):
            k = at[r]
            other = (comp[at] != comp[k]) & (own[k] | own[at])
            other &= (in_i[k] & in_j[at]) | (in_j[k] & in_i[at])
            other &= small[r] | small
            other &= (100 * n[at] >= percent * n[k]) & (100 * n[k] >= percent * n[at])
            c = np.flatnonzero(other)
            if len(c):
                bound = overlap_bound(rows[r], n[k], rows[c], n[at][c])
                may = linked(n[k], n[at][c], bound, percent)
                if may.any():
                    yield k, at[c[may]], bound[may] / (n[k] + n[at][c[may]])


def _apart(comp: np.ndarray) -> np.ndarray:
    """Which rows are outside the largest component."""
    names, number = np.unique(comp, return_counts=True)
    return comp != names[number.argmax()]


def _pairs(a: list[int], b: list[int]) -> pa.Table:
    return pa.table({"a": pa.array(map(min, a, b), pa.int64()), "b": pa.array(map(max, a, b), pa.int64())})


def _most_promising(percent: int):
    """Each class outside a cell's largest component with the one most like it, by the bitmaps, of all other components."""

    def run(cell: pa.Table) -> pa.Table:
        doc, best = cell.column("doc_id").to_numpy(), {}
        for k, others, alike in _partners(cell, percent):
            # a row has partners at its own width and at smaller ones
            best[k] = max(best.get(k, (-1.0, -1)), (float(alike.max()), int(others[alike.argmax()])))
        return _pairs(doc[[*best]].tolist(), doc[[c for _, c in best.values()]].tolist()) if best else _pairs([], [])

    return run


def _undecided(percent: int):
    """The rows of a cell with a possible partner in another component; each id once."""

    def run(cell: pa.Table) -> pa.Table:
        has = np.zeros(len(cell), bool)
        for k, others, _ in _partners(cell, percent):
            has[k] = has[others] = True
        kept = np.flatnonzero(has)
        kept = kept[np.unique(cell.column("doc_id").to_numpy()[kept], return_index=True)[1]]
        return cell.select(["token", "tile", "i", "j", "doc_id", "comp"]).take(pa.array(kept))

    return run


def joining_links(comp: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links between these sets that join their components as far as all links together do, as pairs of places; exact, and fewer than components.

    The overlaps of a set with all others are counted at once, from the lists of sets that hold each of its shingles.
    """
    n = np.array([len(s) for s in sets])
    flat, row = np.concatenate(sets), np.repeat(np.arange(len(sets)), n)
    order = np.argsort(flat, kind="stable")
    first = np.concatenate([[True], flat[order][1:] != flat[order][:-1]])
    kind = np.empty(len(flat), np.int64)
    kind[order] = np.cumsum(first) - 1
    start, holders = np.append(np.flatnonzero(first), len(flat)), row[order]
    begin = np.concatenate([[0], np.cumsum(n)])
    now, found = comp.copy(), []
    for k in np.flatnonzero(_apart(comp)):
        if (now == now[k]).all():
            break
        of = kind[begin[k]:begin[k + 1]]
        size = start[of + 1] - start[of]
        inner = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        overlap = np.bincount(holders[np.repeat(start[of], size) + inner], minlength=len(sets))
        others = np.flatnonzero(linked(n[k], n, overlap, percent) & (now != now[k]))
        for c in others[np.unique(now[others], return_index=True)[1]].tolist():
            found.append((int(k), c))
            now[now == now[c]] = now[k]
    return found


def _joined(percent: int):
    """The links that join the components of a cell."""

    def run(cell: pa.Table) -> pa.Table:
        doc = cell.column("doc_id").to_pylist()
        sets = [np.frombuffer(h, np.uint64) for h in cell.column("hashes").to_pylist()]
        found = joining_links(cell.column("comp").to_numpy(), sets, percent)
        return _pairs([doc[x] for x, _ in found], [doc[y] for _, y in found])

    return run


CELL = ["token", "tile", "i", "j"]


def _cells(rows: DataFrame, maps: DataFrame) -> DataFrame:
    """Rows of the cells of all tiles to compare, with bitmaps; of distinct rows (token, doc_id, bands, n, comp) of which some tokens join several components."""
    tiles_of = F.array_distinct(F.concat("bands", F.transform("bands", lambda b: b - 1)))
    each = rows.withColumn("tile", F.explode(tiles_of)).withColumn("own", F.array_contains("bands", F.col("tile")))
    members = F.count(F.lit(1)).alias("members")
    # tokens with the same members make the same tile: one of them is enough; a member is in a tile once, or its hashes would cancel out
    same = [F.bit_xor(F.xxhash64("doc_id")).alias("x"), F.bit_xor(F.xxhash64("doc_id", F.lit(1))).alias("y")]
    mixed = each.groupBy("token", "tile").agg(members, *same, F.min("comp").alias("low"), F.max("comp").alias("high"),
                                              F.max("own").alias("owned"), F.sum("n").alias("shingles"))
    tiles = mixed.where("low <> high and owned").groupBy("tile", "members", "x", "y").agg(F.min("token").alias("token"), F.max("shingles").alias("shingles"))
    blocks = F.ceil(F.greatest(F.col("members") / BLOCK, F.col("shingles") / BLOCK_SHINGLES)).cast("int")
    tiles = stored(tiles.select("token", "tile", blocks.alias("blocks")), "tiles")
    inside = each.join(tiles, ["token", "tile"]).withColumn("block", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int"))
    # cell (i, j) with i <= j compares the classes of block i with those of block j
    all_blocks = F.sequence(F.lit(0), F.col("blocks") - 1)
    cells = F.transform(all_blocks, lambda k: F.struct(F.least("block", k).alias("i"), F.greatest("block", k).alias("j")))
    inside = inside.withColumn("cell", F.explode(cells)).select(
        "token", "tile", "doc_id", "comp", "own", F.col("cell.i").alias("i"), F.col("cell.j").alias("j"),
        (F.col("block") == F.col("cell.i")).alias("in_i"), (F.col("block") == F.col("cell.j")).alias("in_j"))
    return inside.join(maps, "doc_id")


def _first_links(cells: DataFrame, texts: DataFrame, percent: int, width: int) -> DataFrame:
    """Links among the most promising pairs of the cells, one pair a class at most."""
    pairs = cells.groupBy(*CELL).applyInArrow(_most_promising(percent), "a bigint, b bigint").distinct()
    return verified(pairs, texts, percent, width)


def _last_links(cells: DataFrame, texts: DataFrame, percent: int, width: int) -> DataFrame:
    """Links that join all components that any links in the cells join."""
    kept = cells.groupBy(*CELL).applyInArrow(_undecided(percent), "token bigint, tile int, i int, j int, doc_id bigint, comp bigint")
    kept = stored(kept, "undecided")
    sets = _arrays(kept.select("doc_id"), texts, percent, width)
    joined = kept.join(sets, "doc_id").groupBy(*CELL).applyInArrow(_joined(percent), "a bigint, b bigint")
    return stored(joined.distinct(), "joining-links")


def similar_groups(docs: DataFrame, percent: int = 80, width: int = 5, id_col: str = "doc_id", text_col: str = "text",
                   miss: float = 1e-18) -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest id reachable by links, itself included) of every row.

    Documents link when 100 * intersection >= percent * union of their sets of ``width``-word shingles, A-Z
    lower-cased; fewer words are one shingle. Null, empty and blank texts have no shingle and link to
    nothing. Rows with a null id are a component of their own each, with null as its id. Repeated ids count as one
    document with the links of each row. Shingles are compared by 64-bit hashes.
    """
    spark = docs.sparkSession
    texts = _texts(docs, id_col, text_col)
    profile = stored(texts.mapInArrow(_profiler(width), PROFILE), "shingle-profile")
    sizes = profile.where("n is not null").select("doc_id", "n", "digest")
    total = sizes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    often = F.sum("count") > max(FREQUENT_COUNT, FREQUENT_SHARE * total)
    frequent = profile.where("token is not null").groupBy("token").agg(often.alias("often")).where("often").select("token")
    # no more shingles can have such a share than 1 / FREQUENT_SHARE
    late = np.sort(np.array([r[0] for r in frequent.collect()], np.int64).view(np.uint64))

    full = sizes.where("n > 0 and doc_id is not null")
    classes = full.groupBy("digest").agg(F.min("doc_id").alias("class"), F.max("n").alias("n"))
    # one row of each class speaks for it; a row that shares its id and digest with another is as good
    heads = stored(full.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).select("doc_id").distinct(), "class-heads")
    prefixes = stored(
        texts.join(maybe_broadcast(heads), "doc_id", "left_semi").mapInArrow(
            _prefixes(width, percent, spark.sparkContext.broadcast(late), miss), "token bigint, doc_id bigint"), "prefixes")
    # only shingles of two classes or more can link
    shared = prefixes.groupBy("token").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low <> high").select("token")
    shared = stored(shared, "shared-shingles")
    # a repeated id has the bands of all its texts, and each of its shingles once
    reps = classes.groupBy(F.col("class").alias("doc_id")).agg(
        F.sort_array(F.collect_set(band_of(F.col("n"), percent))).alias("bands"), F.sum("n").alias("n"))
    rows = prefixes.join(shared.hint("merge"), "token", "left_semi").join(reps, "doc_id").select("token", "doc_id", "bands", "n").distinct()
    rows = stored(rows, "candidate-prefixes")
    wanted = maybe_broadcast(rows.select("doc_id").distinct())
    maps = stored(texts.join(wanted, "doc_id", "left_semi").mapInArrow(_set_rows(width, percent, "map"), MAPS), "candidate-maps")

    banded = rows.select("token", "doc_id", F.explode("bands").alias("band"))
    first = banded.groupBy("token", "band").agg(F.min("doc_id").alias("pivot"))
    near = first.unionByName(first.withColumn("band", F.col("band") - 1)).distinct()
    pairs = banded.join(near, ["token", "band"]).where("doc_id <> pivot").select(
        F.least("doc_id", "pivot").alias("a"), F.greatest("doc_id", "pivot").alias("b")).distinct()
    links = verified(possible(pairs, maps, percent), texts, percent, width)
    parts = connected_components(links)
    # the most promising pairs first: what they join needs no further comparison; then all that is left
    for more_links in (_first_links, _last_links):
        joined = rows.join(parts.select(F.col("node").alias("doc_id"), "comp"), "doc_id", "left").withColumn("comp", F.coalesce("comp", "doc_id"))
        more = more_links(_cells(joined, maps), texts, percent, width)
        if not more.isEmpty():
            # components stand for the links that made them: few rounds join what is new
            known = parts.where("node <> comp").select(F.col("node").alias("a"), F.col("comp").alias("b"))
            parts = connected_components(known.unionByName(more))

    # the class of a row, then the component of the class; rows without words are alone
    by_class = classes.join(parts, classes["class"] == parts["node"], "left").select("digest", F.coalesce("comp", "class").alias("found"))
    # stored, so that adaptive execution can split the rows of a large class
    by_class = stored(by_class, "class-components")
    row_class = sizes.withColumn("key", F.when(F.col("n") > 0, F.col("digest")))
    found = row_class.join(by_class.withColumnRenamed("digest", "key").hint("merge"), "key", "left")
    return found.select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("found", "doc_id")).alias("component_id"))


def keep_one(docs: DataFrame, percent: int = 80, width: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, less those similar to one of a smaller id: one document of each group stays.

    Rows that repeat an id stay or go together; rows without an id stay.
    """
    groups = similar_groups(docs, percent, width, id_col, text_col)
    gone = maybe_broadcast(groups.where("component_id <> doc_id").select(F.col("doc_id").alias("id")).distinct())
    return unpacked(packed(docs, id=F.col(id_col).cast("bigint")).join(gone, "id", "left_anti"))
