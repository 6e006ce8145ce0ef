"""Packing documents into sequences: shortest-pack-first over the histogram of lengths."""

from __future__ import annotations

import heapq
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import stored
from strata.llm.shingles import text_bytes
from strata.llm.tokens import BATCH_TEXTS, WordEncoder
from strata.session import session_conf

END_ID = 2
PIECE = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"
# Parts of each length's documents that are numbered apart.
RANK_BLOCKS = 4096


def piece_ranges(n: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of n ids: full sequences, then the rest."""
    return [(a, min(size, n - a)) for a in range(0, n, size)]


def _cutter(tokenizer: str, size: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder.of(tokenizer)
        end = end_id.to_bytes(4, "little")
        for batch in batches:
            doc_ids = iter(batch.column("doc_id").to_pylist())
            for ids, before in encoder.encode(*text_bytes(batch.column("text"))):
                data, out = memoryview(ids.tobytes()), []
                for first, last, doc_id in zip(before[:-1].tolist(), before[1:].tolist(), doc_ids):
                    total = last - first + 1
                    for s, n in piece_ranges(total, size):
                        crc = zlib.crc32(data[4 * (first + s):4 * min(first + s + n, last)])
                        out.append((doc_id, s, n, zlib.crc32(end, crc) if s + n == total else crc, total))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in zip(*out)], ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return run


def document_pieces(docs: DataFrame, tokenizer: str, size: int, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, start, length, ids_crc32 and doc_tokens of every piece: the document's ids and the end id, cut at ``size``."""
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        _cutter(tokenizer, size, end_id), PIECE)


def pack_lengths(histogram: dict[int, int], size: int) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a pattern, number of sequences with it), by shortest-pack-first.

    Lengths are placed longest first. All documents of a length go, as many at once as
    the counts allow, to the pattern with the most room (the shortest pack), as long as it
    has room; the pattern is split in the filled and the left part. Where no
    pattern has room, the documents open patterns of their own. The work depends on
    the number of lengths and patterns alone, never on the number of documents.
    """
    open_patterns: list[list] = []  # heap of (-room, tie, lengths, count): the most room first
    done: list[tuple[tuple[int, ...], int]] = []
    tie = 0
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        grown = []
        while left and open_patterns and -open_patterns[0][0] >= length:
            minus_room, _, lengths, count = heapq.heappop(open_patterns)
            used = min(count, left)
            grown.append((-minus_room - length, (*lengths, length), used))
            left -= used
            if used < count:
                tie += 1
                heapq.heappush(open_patterns, [minus_room, tie, lengths, count - used])
            if not open_patterns or -open_patterns[0][0] < length:
                # the patterns just grown may take more documents of this length
                for r, lens, n in grown:
                    tie += 1
                    _put(open_patterns, done, r, tie, lens, n)
                grown = []
        if left:
            # as many documents of this length in one sequence as go in, then the rest of them
            each = size // length
            full, rest = divmod(left, each)
            if full:
                grown.append((size - each * length, (length,) * each, full))
            if rest:
                grown.append((size - rest * length, (length,) * rest, 1))
        for r, lens, n in grown:
            tie += 1
            _put(open_patterns, done, r, tie, lens, n)
    return done + [(lengths, count) for _, _, lengths, count in open_patterns]


def _put(heap, done, room, tie, lengths, count):
    if room:
        heapq.heappush(heap, [-room, tie, lengths, count])
    else:
        done.append((lengths, count))


def slot_tables(patterns: list[tuple[tuple[int, ...], int]], first_sequence: int = 0) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each length: first ranks, first sequences and offsets of the runs of slots that take its documents by rank."""
    runs: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    taken: dict[int, int] = defaultdict(int)
    base = first_sequence
    for lengths, count in patterns:
        offset = 0
        for length in lengths:
            runs[length].append((taken[length], base, offset))
            taken[length] += count
            offset += length
        base += count
    return {n: tuple(np.array(c, dtype=np.int64) for c in zip(*r)) for n, r in runs.items()}


def _placer(slots: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]], size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            sequence, offset = rank.copy(), np.zeros_like(rank)  # full pieces are sequences of their own, numbered by rank
            for n in np.unique(length[length < size]):
                of = length == n
                first, base, at = slots[int(n)]
                k = np.searchsorted(first, rank[of], side="right") - 1
                sequence[of] = base[k] + rank[of] - first[k]
                offset[of] = at[k]
            rest = batch.select([c for c in batch.schema.names if c != "rank"])
            yield pa.RecordBatch.from_arrays([*rest.columns, pa.array(sequence), pa.array(offset)], [*rest.schema.names, "sequence_id", "offset"])

    return run


def pack(docs: DataFrame, tokenizer: str, size: int = 4096, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every piece of every row of ``docs`` with its place: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document's ids and the end id are cut into full sequences and a rest. The rests
    are packed by ``pack_lengths``; a document that is not longer than a sequence is not cut. Null and
    empty texts are the end id alone. Repeated rows are packed each. Empty
    tables give no piece. Sequence ids are gapless from 0, full pieces first.

    The driver holds the histogram of lengths (at most ``size`` counts) and the patterns, whose
    number the histogram bounds; these go to the tasks. Pieces find their slot by their
    rank among the pieces of their length: counted per block of a hash of the document,
    with the counts of earlier blocks added, so a length that very many documents
    share (a group of copies) is spread over ``RANK_BLOCKS`` groups.
    """
    with session_conf(docs.sparkSession, {"spark.sql.execution.arrow.maxRecordsPerBatch": str(BATCH_TEXTS)}):
        pieces = stored(document_pieces(docs, tokenizer, size, end_id, id_col, text_col), "pieces")
    block = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(RANK_BLOCKS)).cast("int")
    pieces = pieces.withColumn("block", block)
    counts = stored(pieces.groupBy("length", "block").agg(F.count(F.lit(1)).alias("n")), "piece-counts")
    histogram = {int(r[0]): int(r[1]) for r in counts.groupBy("length").agg(F.sum("n")).collect()}
    full = histogram.pop(size, 0)
    slots = slot_tables(pack_lengths(histogram, size), full)
    earlier = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n")
    inside = Window.partitionBy("length", "block").orderBy("doc_id", "start", "ids_crc32")
    ranked = pieces.withColumn("rank", F.row_number().over(inside) - 1).join(starts, ["length", "block"]).withColumn(
        "rank", F.col("rank") + F.col("before"))
    return ranked.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "rank").mapInArrow(
        _placer(slots, size), PIECE + ", sequence_id bigint, offset bigint")
