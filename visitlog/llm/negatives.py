"""Hard negatives of anchor vectors by exact integer products of blocks.

Vectors are rows of integers. Anchors and candidates are dealt into blocks of bounded
size, and a task gets one block of each: a cell of the grid anchors x candidates. In
a cell the scores of a tile of anchors and a tile of candidates are one product of
int64 matrices by Strassen's recursion, seven products of halves instead of eight,
with a zero row or column where a side is odd. Sums and products are modulo 2**64,
so every score that fits a long is exact, whatever the halves add up to on the way.

Two passes go over the grid. The first keeps, for each anchor, a heap of its best
candidates of the same label, its positives. The second keeps, for each anchor and
positive, a heap of the best candidates of another label whose score lies in the
window that the positive's score sets. A heap is merged over the tiles of a cell, and
the heaps of cells are merged by Spark, which drops what ranks too low before it
shuffles. No task holds more than a block of each side and its heaps; no scores are
given out.

Defined cases: a row with a NULL id, label or vector, or a NULL or non-finite
component, takes no part; a component beyond the longs counts as the nearest long; a
shorter vector is filled up with zeros, and an empty one scores 0; rows with the
anchor's id are no positives of it; each of repeated rows counts, as anchor, positive
and negative; an anchor without positives, and one whose positive's score is negative
(its window is empty), has no rows; an empty table gives no rows.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from visitlog.session import stage

# Rows of one block. Blocks of candidates grow with the table up to the bound, so that
# the heaps of a cell are merged from more rows before they are sent.
ANCHOR_BLOCK = 8192
CANDIDATE_BLOCK = 2048, 32_768
CANDIDATE_BLOCKS = 64
TILE = 512
# Sides at which Strassen's recursion ends: rows and columns, and components.
LEAF, DEEP = 128, 16
LEAST = np.iinfo(np.int64).min


def strassen(a, b):
    """The product of two int64 matrices, modulo 2**64."""
    (m, k), n = a.shape, b.shape[1]
    if min(m, n) <= LEAF or k <= DEEP:
        return a @ b
    a = np.pad(a, ((0, m % 2), (0, k % 2)))
    b = np.pad(b, ((0, k % 2), (0, n % 2)))
    i, j, l = (m + 1) // 2, (k + 1) // 2, (n + 1) // 2
    a11, a12, a21, a22 = a[:i, :j], a[:i, j:], a[i:, :j], a[i:, j:]
    b11, b12, b21, b22 = b[:j, :l], b[:j, l:], b[j:, :l], b[j:, l:]
    diagonal = strassen(a11 + a22, b11 + b22)
    low = strassen(a21 + a22, b11)
    right = strassen(a11, b12 - b22)
    left = strassen(a22, b21 - b11)
    high = strassen(a11 + a12, b22)
    out = np.empty((2 * i, 2 * l), np.int64)
    out[:i, :l] = diagonal + left - high + strassen(a12 - a22, b21 + b22)
    out[:i, l:] = right + high
    out[i:, :l] = low + left
    out[i:, l:] = diagonal - low + right + strassen(a21 - a11, b11 + b12)
    return out[:m, :n]


class Heaps:
    """The best ``size`` entries of each of many heaps: score, then smaller id.

    Entries are offered in the order of their ids, so that a stable sort by score keeps
    ties in that order."""

    def __init__(self, heaps, size):
        self.scores = np.full((heaps, size), LEAST)
        self.ids = np.zeros((heaps, size), np.int64)
        self.filled = np.zeros((heaps, size), bool)

    def merge(self, which, scores, ids, valid):
        """Offer a row of entries to each heap of ``which``."""
        scores = np.concatenate([self.scores[which], np.where(valid, scores, LEAST)], 1)
        valid = np.concatenate([self.filled[which], valid], 1)
        ids = np.concatenate([self.ids[which], ids], 1)
        # Descending without overflow; entries that are none come last.
        best = np.lexsort((np.broadcast_to(np.arange(scores.shape[1]), scores.shape), ~scores, ~valid))
        best = best[:, : self.scores.shape[1]]
        self.scores[which] = np.take_along_axis(scores, best, 1)
        self.ids[which] = np.take_along_axis(ids, best, 1)
        self.filled[which] = np.take_along_axis(valid, best, 1)

    def entries(self):
        """``(heap, score, id)`` of all entries."""
        heap, place = np.nonzero(self.filled)
        return heap, self.scores[heap, place], self.ids[heap, place]


def _matrix(column, width):
    """The vectors of a list column as rows, filled up with zeros to ``width``."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if (lengths == width).all():
        return values.reshape(-1, width)
    out = np.zeros((len(lengths), width), np.int64)
    out[np.repeat(np.arange(len(lengths)), lengths), _places(lengths)] = values
    return out


def _places(lengths):
    """0, 1, .. up to each of the lengths, one after another."""
    return np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)


def _longs(table, name):
    return table.column(name).to_numpy().astype(np.int64)


class _Cell:
    """One block of anchors and one of candidates, the latter in the order of ids."""

    def __init__(self, anchors, candidates):
        self.row, self.own, self.label = (_longs(anchors, c) for c in ("anchor", "id", "label"))
        candidates = candidates.take(np.argsort(_longs(candidates, "id"), kind="stable"))
        self.ids, self.labels = _longs(candidates, "id"), _longs(candidates, "label")
        width = max(
            [0, *(pa.compute.max(pa.compute.list_value_length(t.column("vector"))).as_py() or 0 for t in (anchors, candidates))]
        )
        self.anchors, self.vectors = _matrix(anchors.column("vector"), width), _matrix(candidates.column("vector"), width)

    def tiles(self, rows, columns):
        """Scores of runs of the given anchors and candidates: ``(rows, columns, scores)``."""
        for i in range(0, len(rows), TILE):
            some = rows[i : i + TILE]
            for j in range(0, len(columns), TILE):
                others = columns[j : j + TILE]
                yield some, others, strassen(self.anchors[some], self.vectors[others].T)


def _positives(size):
    def of_cell(anchors, candidates):
        if not anchors.num_rows or not candidates.num_rows:
            return _HEAP.empty_table()
        cell = _Cell(anchors, candidates)
        heaps = Heaps(len(cell.row), size)
        # Anchors and candidates of one label at a time: only those scores are wanted.
        order, sorted_labels = np.argsort(cell.labels, kind="stable"), np.sort(cell.labels)
        for label in np.unique(cell.label):
            rows = np.flatnonzero(cell.label == label)
            columns = order[slice(*np.searchsorted(sorted_labels, [label, label + 1]))]
            for some, others, scores in cell.tiles(rows, columns):
                ids = np.broadcast_to(cell.ids[others], scores.shape)
                valid = ids != cell.own[some][:, None]
                best = np.argsort(np.where(valid, ~scores, ~LEAST), axis=1, kind="stable")[:, : size + 1]
                heaps.merge(some, *(np.take_along_axis(x, best, 1) for x in (scores, ids, valid)))
        heap, scores, ids = heaps.entries()
        return pa.table([cell.row[heap], ids, scores], _HEAP)

    return of_cell


_HEAP = pa.schema([("anchor", pa.int64()), ("other", pa.int64()), ("score", pa.int64())])
_FOUND = pa.schema(
    [(n, pa.int64()) for n in ("anchor", "place", "anchor_id", "positive_id", "positive_score", "other", "score")]
)


def window(score, low, high):
    """Least and greatest score of which 100 times lies between ``low`` and ``high``
    times the given scores; no product overflows."""
    tens, rest = np.divmod(score, 100)
    return low * tens - (-low * rest) // 100, high * tens + (high * rest) // 100


def _negatives(size, low, high):
    def of_cell(anchors, candidates):
        if not anchors.num_rows or not candidates.num_rows:
            return _FOUND.empty_table()
        cell = _Cell(anchors, candidates)
        positives = anchors.column("positives").combine_chunks()
        counts = np.diff(positives.offsets.to_numpy())
        flat = positives.flatten()
        score, other = (np.asarray(flat.field(f), np.int64) for f in ("score", "other"))
        # A heap for each anchor and positive, one after another.
        first, of_anchor, place = np.cumsum(counts) - counts, np.repeat(np.arange(len(counts)), counts), _places(counts)
        least, most = window(score, low, high)
        heaps = Heaps(len(score), size)
        for some, others, scores in cell.tiles(np.arange(len(cell.row)), np.arange(len(cell.ids))):
            fits = cell.label[some][:, None] != cell.labels[others]
            scores = np.where(fits, scores, LEAST)
            order = np.argsort(~scores, axis=1, kind="stable")
            scores, fits = np.take_along_axis(scores, order, 1), np.take_along_axis(fits, order, 1)
            for p in range(int(counts[some].max())):
                has = np.flatnonzero(counts[some] > p)
                which = first[some[has]] + p
                # Where the window begins in the sorted row, and as many as a heap holds.
                begin = (scores[has] > most[which][:, None]).sum(1)
                at = begin[:, None] + np.arange(size)
                inside = at < scores.shape[1]
                at = np.minimum(at, scores.shape[1] - 1)
                taken = np.take_along_axis(scores[has], at, 1)
                valid = inside & np.take_along_axis(fits[has], at, 1) & (taken >= least[which][:, None])
                if valid.any():
                    heaps.merge(which, taken, cell.ids[others[np.take_along_axis(order[has], at, 1)]], valid)
        heap, scores, ids = heaps.entries()
        anchor = of_anchor[heap]
        return pa.table(
            [cell.row[anchor], place[heap], cell.own[anchor], other[heap], score[heap], ids, scores], _FOUND
        )

    return of_cell


def _grid(anchors, candidates, columns, rows, function, schema):
    """``function`` over every block of anchors with every block of candidates."""
    one = anchors.withColumn("column", F.explode(F.sequence(F.lit(0), F.lit(columns - 1))))
    other = candidates.withColumn("line", F.explode(F.sequence(F.lit(0), F.lit(rows - 1))))
    return (
        one.groupBy(F.col("block").alias("grid_line"), F.col("column").alias("grid_column"))
        .cogroup(other.groupBy(F.col("line").alias("grid_line"), F.col("block").alias("grid_column")))
        .applyInArrow(function, schema)
    )


def _best(heaps, keys, size, rank):
    """The heaps of all cells, merged."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "other")
    return heaps.withColumn(rank, F.row_number().over(order)).filter(F.col(rank) <= size)


def quantized(vector, factor=256):
    """floor(factor * x) of each component."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * factor))


def mine_negatives(rows, anchor, id_col="vec_id", vector_col="embedding", label_col="label", low=30, high=90,
                   positives=5, negatives=10):
    """For each anchor and positive, the best rows of another label whose score is
    between ``low`` and ``high`` percent of the positive's.

    ``anchor`` is a condition on the columns of ``rows``. Vectors hold integers.
    Returns ``anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score``."""
    spark = rows.sparkSession
    vector = F.col(f"`{vector_col}`")
    valid = rows.select(
        F.col(f"`{id_col}`").cast("long").alias("id"),
        F.col(f"`{label_col}`").cast("long").alias("label"),
        vector.cast("array<long>").alias("vector"),
        F.coalesce(anchor, F.lit(False)).alias("is_anchor"),
    ).filter("id IS NOT NULL AND label IS NOT NULL AND forall(vector, x -> x IS NOT NULL)")
    n, n_anchors = valid.agg(F.count("*"), F.coalesce(F.sum(F.col("is_anchor").cast("long")), F.lit(0))).first()
    least, most = CANDIDATE_BLOCK
    columns = max(1, math.ceil(n / min(most, max(least, n // CANDIDATE_BLOCKS))))
    lines = max(1, math.ceil(n_anchors / ANCHOR_BLOCK))
    # The blocks are stored: a lost executor cannot deal them anew between the passes.
    block = F.spark_partition_id().alias("block")
    candidates = stage(valid.repartition(columns).select("id", "label", "vector", block, "is_anchor"), "candidates")
    anchors = stage(
        candidates.filter("is_anchor").select("id", "label", "vector").repartition(lines).select(
            F.monotonically_increasing_id().alias("anchor"), "id", "label", "vector", block
        ),
        "anchors",
    )
    candidates = candidates.drop("is_anchor")
    heaps = _grid(anchors, candidates, columns, lines, _positives(positives), "anchor long, other long, score long")
    chosen = _best(heaps, ["anchor"], positives, "place").groupBy("anchor").agg(
        F.array_sort(F.collect_list(F.struct("place", "other", "score"))).alias("positives")
    )
    ready = stage(anchors.join(chosen, "anchor"), "positives")
    found = _grid(
        ready, candidates, columns, lines, _negatives(negatives, low, high),
        ", ".join(f"{f.name} long" for f in _FOUND),
    )
    return _best(found, ["anchor", "place"], negatives, "rank").select(
        "anchor_id", "positive_id", "rank", F.col("other").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"),
    )


def label_negatives(embeddings):
    """Hard negatives of the rows whose id is divisible by 100, over quantized vectors
    and labels of which every seventh is moved on by one."""
    finite = F.forall("embedding", lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = embeddings.select("vec_id", moved.alias("label"), "embedding").filter(finite)
    rows = rows.withColumn("embedding", quantized(F.col("embedding")))
    return mine_negatives(rows, F.col("vec_id") % 100 == 0)
