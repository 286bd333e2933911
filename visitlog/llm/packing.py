"""Best-fit packing of documents into windows of a fixed number of tokens, under
conflicts.

A bin carries two bitmaps: the sources and the clusters of equal texts that it
holds. Two documents of one source, or of one cluster, never share a bin. Items
are placed from the largest to the smallest; the search for a bin starts at the
smallest residual that still has room and goes on to the next larger one until a
compatible bin is found, so each item gets the tightest compatible bin. A text
longer than a bin is cut: full bins of its own, and the rest is packed as an item.

Items are dealt out evenly over partitions, without regard to any key, and packed
in blocks of at most ``block_rows`` items; a block is all that a task holds. More
data means more blocks, so the work grows with the input, and a source or
cluster that holds a third of all rows is spread over all blocks.

Defined cases: an item of size 0, or NULL, takes no room and is placed like any
other; a NULL source or cluster conflicts with nothing; repeated rows are items
of their own; an empty table gives no rows.
"""

import math

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import functions as F

from visitlog.llm.frames import bounded_batches, partitions

CAPACITY = 2048
BLOCK_ROWS = 4096
BIN_BITS = 33


class BestFit:
    """Bins of one block, ordered by residual."""

    def __init__(self, capacity):
        self.capacity = capacity
        self.bins = 0
        self.sources, self.clusters, self.used = [], [], []
        self.at = [[] for _ in range(capacity + 1)]  # bins by residual
        self.residuals = 0  # which residuals have bins, as a bitmap
        self.source_bit, self.cluster_bit = {}, {}

    def _bit(self, bits, value):
        return 0 if value is None else 1 << bits.setdefault(value, len(bits))

    def place(self, size, source=None, cluster=None):
        """``(bin, offset)`` of an item; opens a bin if none is compatible."""
        source, cluster = self._bit(self.source_bit, source), self._bit(self.cluster_bit, cluster)
        ahead = self.residuals >> size
        residual = size
        while ahead:
            step = (ahead & -ahead).bit_length() - 1
            residual += step
            for i, found in enumerate(self.at[residual]):
                if not (self.sources[found] & source or self.clusters[found] & cluster):
                    self.at[residual].pop(i)
                    if not self.at[residual]:
                        self.residuals ^= 1 << residual
                    return self._put(found, residual - size, size, source, cluster)
            ahead >>= step + 1
            residual += 1
        self.sources.append(0)
        self.clusters.append(0)
        self.used.append(0)
        self.bins += 1
        return self._put(self.bins - 1, self.capacity - size, size, source, cluster)

    def _put(self, found, residual, size, source, cluster):
        offset = self.used[found]
        self.used[found] += size
        self.sources[found] |= source
        self.clusters[found] |= cluster
        self.at[residual].append(found)
        self.residuals |= 1 << residual
        return found, offset


def pack_block(items, capacity=CAPACITY):
    """Bins of one block of ``(size, source, cluster)``.

    Yields ``(item, piece, start, length, bin, offset)``; ``start`` is the place of
    the piece in its item."""
    bins, pieces = BestFit(capacity), []
    for at, (size, source, cluster) in enumerate(items):
        size = max(0, size or 0)
        full = max(0, math.ceil(size / capacity) - 1)
        for piece in range(full):
            found, offset = bins.place(capacity, source, cluster)
            yield at, piece, piece * capacity, capacity, found, offset
        pieces.append((size - full * capacity, at, full))
    for length, at, piece in sorted(pieces, key=lambda p: (-p[0], p[1])):
        found, offset = bins.place(length, *items[at][1:])
        yield at, piece, piece * capacity, length, found, offset


def pack(items, size_col, source_col, cluster_col, carry, capacity=CAPACITY, block_rows=BLOCK_ROWS):
    """One row per piece: the ``carry`` columns and ``piece, start, length, bin_id,
    bin_offset``. ``items`` is read twice: counted, then dealt out."""
    bounded_batches(items)
    spark = items.sparkSession
    items = items.select(
        *[F.col(f"`{c}`") for c in carry],
        F.col(f"`{size_col}`").cast("long").alias("item_size"),
        F.col(f"`{source_col}`").cast("string").alias("item_source"),
        F.col(f"`{cluster_col}`").cast("string").alias("item_cluster"),
    )
    blocks = math.ceil(items.count() / block_rows)
    dealt = items.repartition(max(1, min(blocks, 4 * partitions(spark))))
    schema = items.select(*[f"`{c}`" for c in carry]).schema
    for name in ("piece", "start", "length", "bin_id", "bin_offset"):
        schema = schema.add(name, "long")

    def task(batches):
        first_bin = TaskContext.get().partitionId() << BIN_BITS
        held, rows = [], 0
        for batch in batches:
            while batch.num_rows:
                take = batch.slice(0, block_rows - rows)
                held.append(take)
                rows += take.num_rows
                batch = batch.slice(take.num_rows)
                if rows == block_rows:
                    out, opened = packed(pa.Table.from_batches(held), first_bin)
                    yield from out
                    first_bin += opened
                    held, rows = [], 0
        if held:
            yield from packed(pa.Table.from_batches(held), first_bin)[0]

    def packed(block, first_bin):
        names = ("item_size", "item_source", "item_cluster")
        placed = list(pack_block(list(zip(*[block.column(n).to_pylist() for n in names])), capacity))
        at, piece, start, length, found, offset = map(list, zip(*placed))
        carried = block.drop_columns(list(names)).take(pa.array(at, pa.int64()))
        for name, values in zip(
            ("piece", "start", "length", "bin_id", "bin_offset"),
            (piece, start, length, [first_bin + b for b in found], offset),
        ):
            carried = carried.append_column(name, pa.array(values, pa.int64()))
        return carried.combine_chunks().to_batches(), max(found) + 1

    return dealt.mapInArrow(task, schema)


def word_count(text):
    """Words of a text column, NULL as none."""
    trimmed = F.regexp_replace(F.coalesce(text, F.lit("")), r"^\s+|\s+$", "")
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, r"\s+")))


def pack_documents(docs, id_col="doc_id", text_col="text", source_col="source", capacity=CAPACITY,
                   block_rows=BLOCK_ROWS):
    """One row per piece of each document; sizes are words, clusters are equal texts."""
    text = F.col(f"`{text_col}`").cast("string")
    items = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        F.col(f"`{source_col}`").cast("string").alias("source"),
        word_count(text).cast("long").alias("n_words"),
        F.when(text != "", F.sha2(text, 256)).alias("cluster"),
    )
    return pack(items, "n_words", "source", "cluster", ["doc_id", "source", "n_words"], capacity, block_rows)
