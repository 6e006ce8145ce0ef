"""Assigning documents to shards through a permutation-filled lookup table."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import packed

# A prime well above the number of shards: slots per shard differ by one at most.
TABLE_SIZE = 65_537


def _number(name: str, salt: str) -> int:
    return int.from_bytes(hashlib.md5(f"{salt}:{name}".encode()).digest()[:8], "big")


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def lookup_table(shards: list[str], size: int = TABLE_SIZE) -> list[int]:
    """For each of ``size`` slots the index of the shard that owns it.

    A shard prefers the slots offset, offset + skip, ... modulo the prime size, a
    permutation that its name fixes. The shards take turns, in the order of their names, and each claims
    the first slot of its list that is still free. When a shard is added or removed, few other
    slots change their owner.
    """
    if not _is_prime(size) or not 0 < len(set(shards)) == len(shards) <= size:
        raise ValueError("the table size must be prime and no less than the number of shards, whose names must differ")
    order = sorted(range(len(shards)), key=lambda i: shards[i])
    following = [_number(s, "offset") % size for s in shards]
    skips = [_number(s, "skip") % (size - 1) + 1 for s in shards]
    table = [-1] * size
    free = size
    while free:
        for i in order[:free]:
            slot = following[i]
            while table[slot] >= 0:
                slot = (slot + skips[i]) % size
            table[slot] = i
            following[i] = (slot + skips[i]) % size
            free -= 1
    return table


def slot_of(key: Column, size: int = TABLE_SIZE) -> Column:
    """Slot of a key: the first 60 bits of its MD5 modulo the table size. A null key has the slot of the empty text."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return (F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("bigint") % size).cast("int")


def assign_shards(docs: DataFrame, shards: list[str], key: str = "doc_id", size: int = TABLE_SIZE) -> DataFrame:
    """``row`` (all columns), ``slot`` and ``shard`` of every row.

    The table, of fixed size whatever the data, is broadcast; each row looks its slot up, without
    a shuffle. Equal keys go to one shard. Empty tables give no rows.
    """
    table = pa.table({"slot": pa.array(range(size), pa.int32()), "shard": [shards[i] for i in lookup_table(shards, size)]})
    owners = F.broadcast(docs.sparkSession.createDataFrame(table))
    return packed(docs, slot=slot_of(F.col(key), size)).join(owners, "slot").select("row", "slot", "shard")
