"""Sharding by a permutation-filled lookup table (operator 8, native).

Every shard has a preference order over the slots of a prime-sized table, an
arithmetic progression with an offset and a skip hashed from its name. The
shards take turns; each claims the first slot of its order that is still free.
The finished table (``size`` numbers, bounded by the parameter) travels with
the plan as one constant array, so placing a document is a hash and an array
access: no shuffle, no join, however hot a source or key is. Shares differ by
at most one slot; taking a shard away moves few documents of the others.

Defined results: a null key hashes like an empty text; repeated rows and equal
keys get the same shard; an empty table stays empty; columns of the input that
are called like an output column are replaced by it, all others are kept.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import hash60

SHARDS = tuple(f"shard-{i:02d}" for i in range(16))
TABLE_SIZE = 2003  # prime, over 100 slots a shard


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def fill_table(shards=SHARDS, size: int = TABLE_SIZE) -> list[int]:
    """Slot -> index of the shard that claimed it. ``size`` must be prime and not below the number of shards."""
    if len(shards) > size or len(set(shards)) < len(shards) or not shards:
        raise ValueError("shards must be distinct, at least one, and not more than slots")
    if size < 2 or any(size % k == 0 for k in range(2, int(size**0.5) + 1)):
        raise ValueError("the table size must be prime")
    place = [_number(f"offset:{s}") % size for s in shards]
    skip = [_number(f"skip:{s}") % (size - 1) + 1 for s in shards]
    table, free, turn = [-1] * size, size, 0
    while free:
        k = turn % len(shards)
        while table[place[k]] >= 0:
            place[k] = (place[k] + skip[k]) % size
        table[place[k]] = k
        free, turn = free - 1, turn + 1
    return table


def slot_of(key: Column, size: int = TABLE_SIZE) -> Column:
    return F.pmod(hash60(key), F.lit(size)).cast("int")


def assign_shards(docs: DataFrame, key: str = "doc_id", shards=SHARDS, size: int = TABLE_SIZE) -> DataFrame:
    """``docs`` with ``slot`` int and ``shard`` string."""
    shards = list(shards)
    owner = F.split(F.lit(",".join(map(str, fill_table(shards, size)))), ",").cast("array<int>")
    names = F.array(*[F.lit(s) for s in shards])
    slot = slot_of(docs[key], size)
    kept = [docs[c] for c in docs.columns if c not in ("slot", "shard")]
    return docs.select(*kept, slot.alias("slot"), F.get(names, F.get(owner, slot)).alias("shard"))


def write_shards(sharded: DataFrame, path: str, files_per_shard: int = 8, key: str = "doc_id") -> None:
    """Parquet folders ``shard=...`` of ``files_per_shard`` files each; rows of a shard are spread over its files by key."""
    part = F.pmod(F.xxhash64(F.col(key)), F.lit(files_per_shard))
    n = sharded.sparkSession.conf.get("spark.sql.shuffle.partitions")
    sharded.repartition(int(n), "shard", part).write.partitionBy("shard").mode("overwrite").parquet(path)
