"""Sharding by jump consistent hashing.

The shard of a row follows from its key and the number of shards alone: no table
of the ring is kept, and with one more shard only the rows that move into it
change their place. Within its shard each row has a gapless slot. Slots come
from the partitions the rows are in: rows are numbered within (partition,
shard), and a running total over the counted partitions is added, so neither a
shard nor a hot key is sorted in one task.

Defined cases: a NULL key is a key of its own; NULL text has 0 bytes; repeated
rows share their shard and take a slot each; an empty table gives no rows.
"""

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from visitlog.llm.frames import HASH
from visitlog.session import stage

SHARDS = 16
PLACE_BITS = 33
# The generator of the published algorithm.
MULTIPLIER = np.uint64(2862933555777941757)


def jump_hash(keys, shards):
    """The shard of each 64-bit key; all keys jump at once until they are past the end."""
    state = np.asarray(keys).astype(np.int64).view(np.uint64).copy()
    shard = np.zeros(len(state), np.int64)
    ahead = np.zeros(len(state), np.int64)
    live = np.arange(len(state))
    while len(live):
        shard[live] = ahead[live]
        state[live] = state[live] * MULTIPLIER + np.uint64(1)
        drawn = (state[live] >> np.uint64(33)).astype(np.float64) + 1.0
        ahead[live] = ((shard[live] + 1) * (float(1 << 31) / drawn)).astype(np.int64)
        live = live[ahead[live] < shards]
    return shard


def shard_of(key, shards):
    """Shard of a column of any type with an order."""

    def jump(keys: pd.Series) -> pd.Series:
        return pd.Series(jump_hash(keys.to_numpy(np.int64), shards).astype(np.int32))

    return F.pandas_udf(jump, "int")(F.xxhash64(key))


def assign_shards(df, key_col, shards=SHARDS):
    """``df``'s columns in a struct ``row``, with ``shard``, ``slot`` within the
    shard, and ``grown_shard``, the shard if there were one more."""
    key = F.col(f"`{key_col}`")
    rows = df.select(
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"),
        shard_of(key, shards).alias("shard"),
        shard_of(key, shards + 1).alias("grown_shard"),
        F.monotonically_increasing_id().alias("place"),
    )
    # The places are stored before two passes read them.
    placed = stage(rows, "places").withColumn("part", F.shiftrightunsigned("place", PLACE_BITS))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # A row per shard and task of the write above.
    starts = (
        placed.groupBy("shard", "part")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    )
    within = Window.partitionBy("shard", "part").orderBy("place")
    numbered = placed.withColumn("within", F.row_number().over(within) - 1)
    return numbered.join(starts.hint(HASH), ["shard", "part"]).select(
        "row", "shard", (F.col("start") + F.col("within")).alias("slot"), "grown_shard"
    )


def shard_documents(docs, shards=SHARDS, id_col="doc_id", text_col="text"):
    """One row per document; texts are reduced to size and checksum first."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    placed = assign_shards(rows, "doc_id", shards)
    return placed.select("row.*", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
