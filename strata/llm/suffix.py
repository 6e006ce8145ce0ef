"""Removal of long repeated byte strings with run-length compressed Burrows-Wheeler indexes.

A string of ``need`` bytes that occurs twice has the same anchor in both places: the smallest
hash of ``GRAM`` bytes in it. So the corpus is cut into contexts, the bytes around each anchor
that any such string can cover, and only contexts of one anchor can share a string.

1. Anchors whose hash occurs once are done. Equal contexts are counted and kept once, so a
   group of copies, however large, is one context with a count.
2. The strings of a context that differs from others are taken in ranges of ``step``
   consecutive starts. All strings of a range hold its core; contexts with different cores share
   none of them, and contexts whose whole range is equal share all. Both are counted by digests.
3. What is left differs only left and right of an equal core. These pieces are indexed in
   blocks of bounded size, with the core as one symbol: the index is the run-length
   Burrows-Wheeler transform of the pieces with the suffix and its common prefix sampled at the
   run ends. The matching statistics of every position are streamed through the text from these samples, and
   strings with another place in the block are marked.
4. Where too many different pieces share a core for a block, the range is divided into shorter
   ranges and step 2 is done again; the shortest range is one string, which leaves nothing to step 3.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import stored
from strata.llm.shingles import Powers, mix, runs_of_texts, text_bytes
from strata.operators.guards import maybe_broadcast

GRAM = 128
BLOCK_BYTES = 1 << 20
# Bytes that never occur in UTF-8: the end of a piece, and the core, which three digits (base 128) after it name.
SEPARATOR, CORE = 0xFF, 0xFE
NAME_BYTES = 3
_POWERS = Powers(np.uint64(0xD1342543DE82EF95))


def gram_hashes(b: np.ndarray, gram: int) -> np.ndarray:
    """Hash of the ``gram`` bytes from every position on."""
    n = len(b)
    up, down = _POWERS.to(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((b.astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])
    return mix((sums[gram:] - sums[:-gram]) * down[: n - gram + 1])


def window_minima(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values, by minima from both ends of blocks."""
    n = len(x)
    top = np.iinfo(x.dtype).max
    blocks = np.concatenate([x, np.full(-n % width, top, x.dtype)]).reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1:n])


def anchors(b: np.ndarray, offsets: np.ndarray, need: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the anchors of all strings of ``need`` bytes inside the texts.

    The anchor is the leftmost smallest upper half of a gram's hash, so it depends on the string alone.
    """
    n = len(b)
    if n < need:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    hashes = gram_hashes(b, gram)
    order = (hashes >> np.uint64(32) << np.uint64(32)) | np.arange(len(hashes), dtype=np.uint64)
    least = window_minima(order, need - gram + 1)
    inside = np.zeros(n + 1, np.int64)  # strings that start here and end in the same text
    first, last = offsets[:-1], np.maximum(offsets[1:] - need + 1, offsets[:-1])
    np.add.at(inside, first, 1)
    np.add.at(inside, last, -1)
    at = (least[np.cumsum(inside)[: len(least)] > 0] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    at = at[np.diff(at, prepend=-1) != 0]
    return at, hashes[at]


ANCHOR = "k1 bigint, k2 bigint, h bigint, c bigint, pos bigint, lo int, hi int"


def _anchor_rows(need: int, gram: int):
    side = need - gram

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            k1, k2 = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("k1", "k2"))
            for first, last in runs_of_texts(offsets):
                start = offsets[first]
                own = offsets[first:last + 1] - start
                b = data[start:offsets[last]]
                at, h = anchors(b, own, need, gram)
                doc = np.searchsorted(own, at, side="right") - 1
                a, z = np.maximum(at - side, own[doc]), np.minimum(at + need, own[doc + 1])
                raw = memoryview(np.ascontiguousarray(b))
                digest = xxhash.xxh3_64_intdigest
                c = np.array([digest(raw[i:j], i - p + side) for i, j, p in zip(a.tolist(), z.tolist(), at.tolist())], np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(k1[first + doc]), pa.array(k2[first + doc]), pa.array(h.view(np.int64)), pa.array(c.view(np.int64)),
                     pa.array(at - own[doc]), pa.array((at - a).astype(np.int32)), pa.array((z - at).astype(np.int32))],
                    ["k1", "k2", "h", "c", "pos", "lo", "hi"])

    return run


def suffix_array(t: np.ndarray) -> np.ndarray:
    """Positions of the suffixes in order, by prefix doubling from words of eight bytes; ties alone are sorted again."""
    n = len(t)
    words = np.lib.stride_tricks.sliding_window_view(np.concatenate([t, np.zeros(8, np.uint8)]), 8)[:n]
    words = np.ascontiguousarray(words).view(">u8").ravel().astype(np.uint64)
    order = np.argsort(words, kind="stable")
    ordered = words[order]
    new = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    reach = 8
    slots = _tied(new)
    while len(slots):
        tied = order[slots]
        following = np.where(tied + reach < n, rank[np.minimum(tied + reach, n - 1)] + 1, 0)
        key = rank[tied] * (n + 1) + following
        sort = np.argsort(key, kind="stable")
        order[slots] = tied[sort]
        key = key[sort]
        new = np.concatenate([[True], key[1:] != key[:-1]])
        rank[order[slots]] = np.maximum.accumulate(np.where(new, slots, 0))
        slots = slots[_tied(new)]
        reach *= 2
    return order


def _tied(new: np.ndarray) -> np.ndarray:
    """Indices of runs of more than one element, given where runs begin."""
    ends = np.concatenate([new[1:], [True]])
    return np.flatnonzero(~(new & ends))


def common_prefixes(t: np.ndarray, p: np.ndarray, q: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Length of the common prefix of the suffixes at p and at q, for each pair, as far as ``most`` (or a little further)."""
    n = len(t)
    padded = np.concatenate([t, np.zeros(8, np.uint8)])
    words = np.lib.stride_tricks.sliding_window_view(padded, 8)
    length = np.zeros(len(p), np.int64)
    live = np.arange(len(p))
    while len(live):
        i, j = p[live] + length[live], q[live] + length[live]
        room = n - np.maximum(i, j)
        same = (words[np.minimum(i, n)] == words[np.minimum(j, n)])
        step = np.where(same.all(axis=1), 8, same.argmin(axis=1))
        length[live] += np.minimum(step, room)
        live = live[(step == 8) & (room > 8) & (length[live] < most[live])]
    return length


@dataclass(frozen=True)
class RunLengthIndex:
    """A run-length Burrows-Wheeler transform with samples where runs end and the next begin."""

    size: int
    symbols: np.ndarray  # of each run
    heads: np.ndarray  # rank of each run's first suffix
    places: np.ndarray  # text position of that suffix, ascending
    prefixes: np.ndarray  # its common prefix with the last suffix of the run before

    @staticmethod
    def build(t: np.ndarray, order: np.ndarray, begin: np.ndarray) -> RunLengthIndex:
        """``begin`` are the ascending starts of the text's segments. Their first suffixes are sampled too, so that
        no value has to reach beyond its segment, and prefixes are only measured to the segment's end.
        """
        last = t[order - 1]  # the symbol before each suffix
        heads = np.concatenate([[0], np.flatnonzero(last[1:] != last[:-1]) + 1])
        rank = np.empty(len(t), np.int64)
        rank[order] = np.arange(len(t))
        sampled = np.union1d(heads, rank[begin])
        place = order[sampled]
        end = np.append(begin[1:], len(t))[np.searchsorted(begin, place, side="right") - 1]
        before = order[np.maximum(sampled - 1, 0)]
        prefixes = np.where(sampled > 0, common_prefixes(t, place, before, end - place), 0)
        by_place = np.argsort(order[sampled])
        return RunLengthIndex(len(t), last[heads], heads, order[sampled][by_place], prefixes[by_place])

    def matching_statistics(self) -> np.ndarray:
        """For each text position the longest match with the suffix ordered just before it, exact as far as its segment goes.

        Streamed through the text: inside a run the value falls by one from position to position; at
        a run's head it starts anew from the sample.
        """
        place = np.zeros(self.size, np.int64)
        value = np.zeros(self.size, np.int64)
        place[self.places] = self.places
        value[self.places] = self.prefixes
        place = np.maximum.accumulate(place)
        return value[place] - (np.arange(self.size) - place)


def repeated_spans(segments: list[bytes], last_start: np.ndarray, need: int):
    """Where strings of ``need`` bytes of each segment occur in another place: arrays (segment, first start, last start).

    Only strings that start at most ``last_start`` bytes into their segment are looked at.
    """
    lengths = np.array([len(s) for s in segments])
    t = np.frombuffer(b"".join(s + bytes([SEPARATOR]) for s in segments), np.uint8)
    begin = np.concatenate([[0], np.cumsum(lengths + 1)])
    order = suffix_array(t)
    matches = RunLengthIndex.build(t, order, begin[:-1]).matching_statistics()
    segment = np.repeat(np.arange(len(segments)), lengths + 1)
    inner = np.arange(len(t)) - begin[segment]
    # suffixes that begin with the same need bytes are neighbours: a shorter match starts a new class
    classes = np.cumsum(matches[order] < need)
    fits = (inner[order] + need <= lengths[segment[order]]) & (inner[order] <= last_start[segment[order]])
    members, classes = order[fits], classes[fits]
    _, place, size = np.unique(classes, return_inverse=True, return_counts=True)
    marked = np.sort(members[size[place] > 1]) if len(members) else members
    if not len(marked):
        return (np.zeros(0, np.int64),) * 3
    own = segment[marked]
    new = np.concatenate([[True], (np.diff(marked) > 1) | (np.diff(own) != 0)])
    last = marked[np.append(np.flatnonzero(new)[1:] - 1, len(marked) - 1)]
    return own[new], marked[new] - begin[own[new]], last - begin[own[new]]


SPAN = "h bigint, c bigint, low int, high int"


def range_steps(starts: int) -> list[int]:
    """Lengths of the ranges, each a divisor of the one before: thirds or less of it, down to one string."""
    steps, step = [], starts
    while step > 1:
        step = max(d for d in range(1, step) if step % d == 0 and (3 * d <= step or d == 1))
        steps.append(step)
    return steps or [1]


def _edges(a: int, step: int, need: int, lo: int, size: int) -> tuple[int, int]:
    """First and last start, relative to the anchor, of the strings of a range that the context holds; empty if first > last."""
    return max(a, -lo), min(a + step - 1, size - lo - need)


RANGE = "h bigint, c bigint, a int, core bigint, whole bigint, low int, high int"


def _ranges(parent: int, step: int, need: int):
    """The ranges of ``step`` starts of each context's range of ``parent`` starts from ``a`` on: digests of the core and of the whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for batch in batches:
            rows = []
            for h, c, lo, raw, start in zip(*(batch.column(x).to_pylist() for x in ("h", "c", "lo", "bytes", "a"))):
                raw = memoryview(raw)
                for a in range(start, start + parent, step):
                    first, last = _edges(a, step, need, lo, len(raw))
                    if first <= last:
                        core = digest(raw[lo + a + step - 1:lo + a + need])
                        whole = digest(raw[lo + first:lo + last + need], (first - a) * step + last - a)
                        rows.append((h, c, a, core - (core >> 63 << 64), whole - (whole >> 63 << 64), first, last + need))
            cols = list(zip(*rows)) if rows else [[]] * 7
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(cols, kinds)], ["h", "c", "a", "core", "whole", "low", "high"])

    return run


def _index_block(step: int, need: int):
    def run(block: pa.Table) -> pa.Table:
        h, c, a, core, lo = (block.column(n).to_numpy(zero_copy_only=False) for n in ("h", "c", "a", "core", "lo"))
        _, group = np.unique(np.stack([h, a, core]), axis=1, return_inverse=True)
        segments, starts, firsts = [], [], []
        for g, x, l, raw in zip(group.ravel().tolist(), a.tolist(), lo.tolist(), block.column("bytes").to_pylist()):
            first, last = _edges(x, step, need, l, len(raw))
            z = x + step - 1
            name = bytes([CORE, *(g >> 7 * k & 127 for k in range(NAME_BYTES))])
            segments.append(raw[l + first:l + z] + name + raw[l + x + need:l + last + need])
            starts.append(last - first)
            firsts.append(first)
        own, first, last = repeated_spans(segments, np.array(starts), step + NAME_BYTES)
        base = np.array(firsts)[own]
        return pa.table({
            "h": pa.array(h[own]), "c": pa.array(c[own]), "low": pa.array((base + first).astype(np.int32)),
            "high": pa.array((base + last + need).astype(np.int32))})

    return run


def _cut_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of each wanted context of a text."""
    for batch in batches:
        rows = []
        for text, wanted in zip(batch.column("text").to_pylist(), batch.column("wanted").to_pylist()):
            raw = text.encode()
            rows += [(w["h"], w["c"], w["lo"], raw[w["pos"] - w["lo"]:w["pos"] + w["hi"]]) for w in wanted]
            if len(rows) > 2_000:
                yield _context_batch(rows)
                rows = []
        if rows:
            yield _context_batch(rows)


def _context_batch(rows):
    return pa.RecordBatch.from_arrays(
        [pa.array(v, t) for v, t in zip(zip(*rows), [pa.int64(), pa.int64(), pa.int32(), pa.binary()])], ["h", "c", "lo", "bytes"])


CONTEXT = "h bigint, c bigint, lo int, bytes binary"


def _shared_spans(contexts: DataFrame, need: int, starts: int) -> DataFrame:
    """(h, c, low, high): where strings of a context (h, c, lo, bytes) are in another context of the same anchor too, relative to it."""
    found = None
    parents, parent = None, starts
    for step in range_steps(starts):
        if parents is None:
            rows = contexts.withColumn("a", F.lit(1 - starts))
        else:
            rows = contexts.join(parents, ["h", "c"])
        rows = stored(rows.mapInArrow(_ranges(parent, step, need), RANGE), "ranges")
        entries = rows.groupBy("h", "a", "core", "whole").agg(F.count(F.lit(1)).alias("n"), F.min("c").alias("c"))
        entries = stored(entries, "range-classes")
        same = entries.where("n > 1").select("h", "a", "whole")
        equal = rows.join(same, ["h", "a", "whole"], "left_semi").select("h", "c", "low", "high")
        found = equal if found is None else found.unionByName(equal)
        if step == 1:
            break
        groups = stored(entries.groupBy("h", "a", "core").agg(F.count(F.lit(1)).alias("m")).where("m > 1"), "cores")
        size = 2 * step + NAME_BYTES
        differing = entries.join(groups, ["h", "a", "core"]).select("h", "c", "a", "core", "m")
        fit = F.col("m") * size <= BLOCK_BYTES
        pieces = groups.where(fit).agg(F.coalesce(F.sum("m"), F.lit(0))).first()[0]
        blocks = max(1, -(-pieces * size // BLOCK_BYTES))
        block = F.pmod(F.xxhash64("h", "a", "core"), F.lit(blocks)).alias("block")
        in_blocks = contexts.join(differing.where(fit), ["h", "c"]).select("h", "c", "a", "core", "lo", "bytes", block)
        found = found.unionByName(in_blocks.groupBy("block").applyInArrow(_index_block(step, need), SPAN))
        parents, parent = stored(differing.where(~fit).select("h", "c", "a"), "crowded-ranges"), step
    return found


def _remove(with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
                raw = (text or "").encode()
                merged: list[list[int]] = []
                for s in sorted((s["low"], s["high"]) for s in spans or []):
                    if merged and s[0] <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], s[1])
                    else:
                        merged.append(list(s))
                edges = [0, *(e for m in merged for e in m), len(raw)]
                kept = b"".join(raw[a:z] for a, z in zip(edges[::2], edges[1::2]))
                out.append((len(raw), len(raw) - len(kept), len(merged), hashlib.sha256(kept).hexdigest(), merged, kept if with_text else None))
            cols = list(zip(*out)) if out else [[]] * 6
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.list_(pa.int64())), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(c, k) for c, k in zip(cols, kinds)]],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "removed", "kept_bytes"])

    return run


REMOVED = ("doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, removed array<array<bigint>>, kept_bytes binary")


def _keys(text: Column) -> list[Column]:
    """128 bits that stand for a text."""
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2")]


def remove_repeats(docs: DataFrame, need: int = 400, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """Remove every byte covered by a ``need``-byte string that starts anywhere else too, in the same or another row.

    Returns for each row doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256 (of
    the remaining bytes in order), removed ([from, to) of each run) and, if ``with_text``, kept_bytes.
    Strings are judged on the input and never cross rows. Null text is empty; texts shorter than
    ``need`` keep all bytes. Repeated rows are repeats of each other. Ids may be null or repeat: texts are
    told apart by 128 bits of their content.
    """
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    keyed = texts.select("doc_id", "text", *_keys(F.col("text")))
    long = keyed.where(F.octet_length("text") >= need)
    found = stored(long.select("k1", "k2", "text").mapInArrow(_anchor_rows(need, gram), ANCHOR), "anchors")
    # the aggregated side of a join is stored first, so that adaptive execution can split the rows of a hot key on the other
    twice = stored(found.groupBy("h").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select("h"), "repeated-hashes")
    again = stored(found.join(twice.hint("merge"), "h", "left_semi"), "repeated-anchors")

    first = F.min(F.struct("k1", "k2", "pos", "lo", "hi")).alias("at")
    contexts = stored(again.groupBy("h", "c").agg(F.count(F.lit(1)).alias("n"), first).select("h", "c", "n", "at.*"), "contexts")
    # a context that occurs twice repeats as a whole
    whole = contexts.where("n > 1").select("h", "c", (-F.col("lo")).alias("low"), F.col("hi").alias("high"))
    several = stored(contexts.groupBy("h").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select("h"), "several-contexts")
    differing = stored(contexts.join(several.hint("merge"), "h", "left_semi"), "differing-contexts")
    wanted = differing.groupBy("k1", "k2").agg(F.collect_list(F.struct("h", "c", "pos", "lo", "hi")).alias("wanted"))
    some = long.join(maybe_broadcast(differing.select("k1", "k2").distinct()), ["k1", "k2"], "left_semi")
    some = some.groupBy("k1", "k2").agg(F.min("text").alias("text"))
    cut = stored(some.join(wanted, ["k1", "k2"]).mapInArrow(_cut_contexts, CONTEXT), "context-bytes", "zstd")
    spans = stored(whole.unionByName(_shared_spans(cut, need, need - gram + 1)).distinct(), "context-spans")

    placed = again.join(spans, ["h", "c"]).select("k1", "k2", (F.col("pos") + F.col("low")).alias("low"), (F.col("pos") + F.col("high")).alias("high"))
    removed = placed.distinct().groupBy("k1", "k2").agg(F.collect_list(F.struct("low", "high")).alias("spans"))
    removed = stored(removed, "text-spans")
    # a merge join at every size: how far copies spread over rows is not known, and its hot keys can be split
    return keyed.join(removed.hint("merge"), ["k1", "k2"], "left").select("doc_id", "text", "spans").mapInArrow(_remove(with_text), REMOVED)
