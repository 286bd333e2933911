"""Near duplicates: MinHash signatures and a multi-index Hamming join.

A document is its set of five-word shingles. Its signature is ``SYMBOLS`` minima,
of which ``BITS`` bits each are kept. Two documents whose sets overlap by 75 % or
more differ in a quarter of the symbols on average, and in more than ``RADIUS``
of 40 with a probability of about two in a million at exactly 75 %.

All pairs within ``RADIUS`` are found without comparing all pairs. The signature is
cut into 8 chunks of 5 symbols. 23 errors in 8 chunks leave one chunk with 2
errors at most (pigeonhole), and every choice of 2 wrong symbols in a chunk gives
a key of the 3 others: two signatures within the radius share one of the 80 keys.

Large groups of copies are not expanded into pairs:

1. Equal sets are one class, known by a stored number.
2. In each bucket (classes with a key in common) all classes are paired with the
   smallest number only, and each class is confirmed against the nearest of those.
   Confirmed links join most copies of a group in one component.
3. In buckets that still hold more than one component, classes of different
   components within the radius are compared by signature. Each bucket tells only
   how they hang together (a forest, never all pairs); buckets together give
   regions of classes that may be linked.
4. Each region is sent to tasks with the full sets of its classes, each once per
   block, and all pairs of different components are confirmed there by counting
   common shingles for many classes at once. Only links that join two components
   are given out.

A hot bucket or region is cut into blocks, and pairs of blocks are compared; only
classes outside its main component go to all blocks.

Links are confirmed on the full sets (64-bit hashes of the shingles). Only texts
of classes that share a bucket are fetched again for that.

Defined cases: NULL or empty text, or text without words, has an empty set and is
linked with nothing; fewer than five words are one shingle; rows are told apart by id
and text, so unlike texts under one id are not linked by it, and both stay; rows of one id
and text are one document; a row with a NULL id is kept, and names no component; an empty
table gives no rows.
"""

import hashlib
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitlog.llm.components import connected_components
from visitlog.llm.frames import HASH, MERGE, bounded_batches, free_name
from visitlog.llm.words import hash_words, mix, random_words, row_slices, text_bytes
from visitlog.session import stage

SHINGLE = 5
PERCENT = 75
SYMBOLS, BITS, CHUNK, ERRORS = 40, 16, 5, 2
RADIUS = SYMBOLS // CHUNK * (ERRORS + 1) - 1
# Classes per block, by signature; and shingles per block of sets, so that a block of long
# texts has few of them.
BLOCK, SET_BLOCK = 1024, 1 << 18

_FACTORS = random_words(SHINGLE + 1, 1) | np.uint64(1)
_SCALES, _SHIFTS = random_words(SYMBOLS, 2) | np.uint64(1), random_words(SYMBOLS, 3)
# The symbols of each key: every choice of chunk, and of the symbols taken as right.
_KEYS = np.array([
    [chunk + i for i in kept]
    for chunk in range(0, SYMBOLS, CHUNK)
    for kept in combinations(range(CHUNK), CHUNK - ERRORS)
])


def shingles(column):
    """Hashes of the shingles of each text, with repeats, and where each text begins."""
    data, offsets = text_bytes(column)
    hashes, bounds, _, _ = hash_words(data, offsets)
    words = np.diff(bounds)
    counts = np.where(words >= SHINGLE, words - SHINGLE + 1, np.minimum(words, 1))
    starts = np.concatenate([[0], np.cumsum(counts)])
    first = np.repeat(bounds[:-1] - starts[:-1], counts) + np.arange(starts[-1])
    size = np.repeat(np.minimum(words, SHINGLE), counts)
    padded = np.concatenate([hashes, np.zeros(SHINGLE, np.uint64)])
    total = size.astype(np.uint64) * _FACTORS[SHINGLE]
    for k in range(SHINGLE):
        total += np.where(k < size, padded[first + k] * _FACTORS[k], np.uint64(0))
    return mix(total), starts


def signatures(hashes, starts):
    """One row of symbols per text; texts without shingles get zeros."""
    out = np.zeros((len(starts) - 1, SYMBOLS), np.uint16)
    some = np.flatnonzero(np.diff(starts))
    if len(some):
        for i in range(SYMBOLS):
            least = np.minimum.reduceat(hashes * _SCALES[i] + _SHIFTS[i], starts[some])
            out[some, i] = (mix(least) >> np.uint64(64 - BITS)).astype(np.uint16)
    return out


def _sets(column):
    for begin, end in row_slices(column):
        hashes, starts = shingles(column.slice(begin, end - begin))
        yield hashes, starts, [np.unique(hashes[a:b]) for a, b in zip(starts[:-1], starts[1:])]


def _sign(batches):
    for batch in batches:
        sizes, digests, symbols = [], [], []
        for hashes, starts, sets in _sets(batch.column("text")):
            sizes += [len(s) for s in sets]
            digests += [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
            symbols += [row.tobytes() for row in signatures(hashes, starts)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("mark"), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
             pa.array(symbols, pa.binary())],
            ["doc_id", "mark", "n_shingles", "digest", "signature"],
        )


def _full_sets(batches):
    for batch in batches:
        sets = [s.tobytes() for _, _, some in _sets(batch.column("text")) for s in some]
        yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(sets, pa.binary())], ["node", "shingles"])


def _symbols(column):
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, SYMBOLS)


def _index(batches):
    for batch in batches:
        for begin in range(0, batch.num_rows, 1000):
            some = batch.slice(begin, 1000)
            chosen = _symbols(some.column("signature")).astype(np.int64)[:, _KEYS]
            keys = np.broadcast_to(np.arange(len(_KEYS), dtype=np.int64), chosen.shape[:2])
            for k in range(_KEYS.shape[1]):
                keys = (keys << BITS) | chosen[:, :, k]
            nodes = some.column("node").take(pa.array(np.repeat(np.arange(some.num_rows), len(_KEYS))))
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), nodes], ["key", "node"])


def _distances(batches):
    for batch in batches:
        apart = (_symbols(batch.column("sign_a")) != _symbols(batch.column("sign_b"))).sum(1)
        near = pa.array(apart <= RADIUS)
        yield pa.RecordBatch.from_arrays(
            [batch.column("a").filter(near), batch.column("b").filter(near), pa.array(apart).filter(near)],
            ["a", "b", "distance"],
        )


def _confirm(batches):
    for batch in batches:
        linked = []
        for a, b in zip(batch.column("set_a"), batch.column("set_b")):
            a, b = np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64)
            both = len(np.intersect1d(a, b, assume_unique=True))
            linked.append(100 * both >= PERCENT * (len(a) + len(b) - both))
        keep = pa.array(linked, pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], ["a", "b"])


def _groups(batches):
    """Runs of rows that agree on ``key, first, second``, as tables; rows come sorted by them."""
    held, group = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        ids = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "first", "second")]
        cuts = np.flatnonzero(np.any([x[1:] != x[:-1] for x in ids], axis=0)) + 1
        for begin, end in zip([0, *cuts], [*cuts, batch.num_rows]):
            this = tuple(x[begin] for x in ids)
            if held and this != group:
                yield group[1] != group[2], pa.Table.from_batches(held).combine_chunks()
                held = []
            group = this
            held.append(batch.slice(begin, end - begin))
    if held:
        yield group[1] != group[2], pa.Table.from_batches(held).combine_chunks()


def _codes(table):
    """The rows' components as small numbers."""
    return table.column("component").combine_chunks().dictionary_encode().indices.to_numpy()


def _joined(labels, i, others):
    """Of ``others``, one for each label that is not yet that of ``i``; they get it."""
    found, first = np.unique(labels[others], return_index=True)
    new = found != labels[i]
    if new.any():
        labels[np.isin(labels, found[new])] = labels[i]
    return others[first[new]]


def _compare(batches):
    """How the classes of each bucket hang together within the radius, across components."""
    for across, rows in _groups(batches):
        if rows.num_rows < 2:
            continue
        symbols, codes = _symbols(rows.column("signature")), _codes(rows)
        block, labels, left, right = rows.column("block").to_numpy(), np.arange(rows.num_rows), [], []
        for i in range(len(symbols) - 1):
            other = codes[i + 1 :] != codes[i]
            if across:
                other &= block[i + 1 :] != block[i]
            at = np.flatnonzero(other) + i + 1
            if len(at):
                at = at[(symbols[at] != symbols[i]).sum(1) <= RADIUS]
                new = _joined(labels, i, at)
                left += [i] * len(new)
                right += new.tolist()
        nodes = rows.column("node").combine_chunks()
        yield pa.RecordBatch.from_arrays(
            [nodes.take(pa.array(left, pa.int64())), nodes.take(pa.array(right, pa.int64()))], ["a", "b"]
        )


def _confirm_regions(batches):
    """Components of each region's block pair that a confirmed link joins."""
    for across, rows in _groups(batches):
        if rows.num_rows < 2:
            continue
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in rows.column("shingles").combine_chunks()]
        sizes = np.array([len(x) for x in sets])
        starts = np.cumsum(sizes) - sizes
        names, flat = np.unique(np.concatenate(sets), return_inverse=True)
        labels, block = _codes(rows).astype(np.int64), rows.column("block").to_numpy()
        mine, left, right = np.zeros(len(names), bool), [], []
        main = np.bincount(labels).argmax()
        for i in np.flatnonzero(labels != main):
            own = flat[starts[i] : starts[i] + sizes[i]]
            mine[own] = True
            both = np.add.reduceat(mine[flat].astype(np.int32), starts)
            mine[own] = False
            linked = (labels != labels[i]) & (100 * both >= PERCENT * (sizes[i] + sizes - both))
            if across:
                linked &= block != block[i]
            new = _joined(labels, i, np.flatnonzero(linked))
            left += [i] * len(new)
            right += new.tolist()
        components = rows.column("component").combine_chunks()
        yield pa.RecordBatch.from_arrays(
            [components.take(pa.array(left, pa.int64())), components.take(pa.array(right, pa.int64()))], ["a", "b"]
        )


def _schema(id_type, /, **others):
    fields = [T.StructField(n, id_type if isinstance(k, str) else k) for n, k in others.items()]
    return T.StructType(fields)


def sign(docs, id_col="doc_id", text_col="text"):
    """``doc_id``, ``mark`` of the text, ``n_shingles``, a digest of the set and the
    signature of each row; narrow."""
    bounded_batches(docs)
    rows = _marked(docs, id_col, text_col)
    schema = _schema(
        rows.schema["doc_id"].dataType, doc_id="id", mark=T.LongType(), n_shingles=T.LongType(),
        digest=T.BinaryType(), signature=T.BinaryType(),
    )
    return rows.mapInArrow(_sign, schema)


def _marked(docs, id_col="doc_id", text_col="text"):
    """``doc_id, mark, text``; with the id, the mark tells a document from others."""
    text = F.col(f"`{text_col}`").cast("string")
    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.xxhash64(text).alias("mark"), text.alias("text"))


def _within_radius(pairs, signed, node):
    """Pairs ``a, b`` whose signatures are near, with their distance."""
    of_a = signed.select(F.col("node").alias("a"), F.col("signature").alias("sign_a"))
    of_b = signed.select(F.col("node").alias("b"), F.col("signature").alias("sign_b"))
    joined = pairs.join(of_b, "b").join(of_a, "a")
    return joined.mapInArrow(_distances, _schema(node, a="node", b="node", distance=T.LongType()))


def _confirmed(pairs, sets, node):
    """Pairs ``a, b`` whose full sets overlap enough. ``a`` may be the same in very
    many pairs: the join splits it, as each row is a pair of its own."""
    of_a = sets.select(F.col("node").alias("a"), F.col("shingles").alias("set_a"))
    of_b = sets.select(F.col("node").alias("b"), F.col("shingles").alias("set_b"))
    joined = pairs.select("a", "b").join(of_b.hint(MERGE), "b").join(of_a.hint(MERGE), "a")
    return joined.mapInArrow(_confirm, _schema(node, a="node", b="node"))


def _in_blocks(members, groups, size):
    """Rows of ``key, node, component`` dealt out to pairs of blocks of their group.

    ``groups`` has ``key``, the ``main`` component, and how many rows (or shingles) of
    the group are in it (``n_in``) and outside (``n_out``). Blocks of the main component
    meet those outside, and those meet each other."""
    joined = members.join(groups, "key")
    blocks_in = F.ceil(F.col("n_in") / size).cast("int")
    blocks_out = F.ceil(F.col("n_out") / size).cast("int")
    within, spread = F.col("component") == F.col("main"), F.xxhash64("node")
    block = F.when(within, F.pmod(spread, blocks_in)).otherwise(blocks_in + F.pmod(spread, blocks_out)).cast("int")
    met = F.when(within, F.sequence(blocks_in, blocks_in + blocks_out - 1)).otherwise(
        F.sequence(F.lit(0), blocks_in + blocks_out - 1)
    )
    return joined.withColumn("block", block).withColumn("met", F.explode(met)).select(
        "key", F.least("block", "met").alias("first"), F.greatest("block", "met").alias("second"), "block", "node",
        "component",
    )


def _by_group(dealt):
    return dealt.repartition("key", "first", "second").sortWithinPartitions("key", "first", "second")


def _regions(star, near, known, signed, node):
    """``(node, component, key)`` of classes that may still be linked with classes of
    another component; ``key`` names their region."""
    of_node = known.select("node", F.col("component").alias("of_node"))
    of_leader = known.select(F.col("node").alias("leader"), F.col("component").alias("of_leader"))

    def with_components(pairs):
        return (
            pairs.join(of_node, "node", "left")
            .join(of_leader, "leader", "left")
            .withColumns({"of_node": F.coalesce("of_node", "node"), "of_leader": F.coalesce("of_leader", "leader")})
        )

    # A bucket of two has only the pair with its leader.
    in_star = with_components(star.filter("members > 2").select("key", "leader", "node"))
    outside = F.col("of_node") != F.col("of_leader")
    mixed = (
        in_star.groupBy("key")
        .agg(F.count_if(outside).alias("n_out"), (F.count_if(~outside) + 1).alias("n_in"),
             F.min("leader").alias("leader"), F.min("of_leader").alias("main"))
        .filter("n_out > 0")
    )
    mixed = stage(mixed, "mixed")
    members = in_star.select("key", "node", F.col("of_node").alias("component"))
    led = mixed.select("key", F.col("leader").alias("node"), F.col("main").alias("component"))
    dealt = _in_blocks(members.unionByName(led), mixed.drop("leader"), BLOCK).join(signed, "node")
    within_buckets = _by_group(dealt).mapInArrow(_compare, _schema(node, a="node", b="node"))
    with_leaders = with_components(near.select(F.col("a").alias("leader"), F.col("b").alias("node"))).filter(outside)
    edges = within_buckets.unionAll(with_leaders.select(F.col("leader").alias("a"), F.col("node").alias("b")))
    found = connected_components(edges.distinct()).select("node", F.col("component").alias("key"))
    return found.join(known, "node", "left").withColumn("component", F.coalesce("component", "node"))


def _late_links(regions, sets, sizes, node):
    """Pairs of components that links within the regions join; ``sizes`` has ``node`` and
    ``n``, its number of shingles."""
    regions = stage(regions.join(sizes, "node"), "regions")
    sizes = regions.groupBy("key", "component").agg(F.sum("n").alias("n"))
    groups = (
        sizes.groupBy("key")
        .agg(F.max_by("component", F.struct("n", "component")).alias("main"), F.max("n").alias("n_in"),
             F.sum("n").alias("n"))
        .select("key", "main", "n_in", (F.col("n") - F.col("n_in")).alias("n_out"))
        .filter("n_out > 0")
    )
    dealt = _in_blocks(regions, groups, SET_BLOCK).join(sets.hint(MERGE), "node")
    return _by_group(dealt).mapInArrow(_confirm_regions, _schema(node, a="node", b="node"))


def _link(docs):
    """The signed rows of ``doc_id, text``, and the classes of their sets: ``node, doc_id,
    mark`` of the first row, ``digest``, and ``component``, the first ``doc_id, mark,
    node`` of all classes that can be reached."""
    rows = stage(sign(docs), "signed")
    node = T.LongType()
    classes = stage(
        rows.filter("n_shingles > 0 AND doc_id IS NOT NULL")
        .groupBy("digest")
        .agg(F.min(F.struct("doc_id", "mark")).alias("first"), F.first("signature").alias("signature"),
             F.first("n_shingles").alias("n"))
        .select(F.monotonically_increasing_id().alias("node"), "digest", "signature", "n", "first.*"),
        "classes",
    )
    signed = classes.select("node", "signature")

    keys = signed.mapInArrow(_index, _schema(node, key=T.LongType(), node="node"))
    leaders = (
        keys.groupBy("key").agg(F.min("node").alias("leader"), F.count(F.lit(1)).alias("members")).filter("members > 1")
    )
    star = keys.join(leaders.hint(HASH), "key").filter("node != leader")
    star = stage(star.select("key", "leader", "node", "members"), "buckets")

    pairs = star.select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct()
    near = stage(_within_radius(pairs, signed, node), "near")
    nodes = star.select("node").unionAll(star.select("leader")).distinct()
    wanted = classes.select("node", "doc_id", "mark").join(nodes, "node")
    texts = _marked(docs).join(wanted.hint(MERGE), ["doc_id", "mark"]).select("node", "text")
    sets = stage(texts.mapInArrow(_full_sets, _schema(node, node="node", shingles=T.BinaryType())), "sets")

    nearest = near.groupBy("b").agg(F.min_by("a", F.struct("distance", "a")).alias("a"))
    known = connected_components(_confirmed(nearest, sets, node))

    late = _late_links(_regions(star, near, known, signed, node), sets, classes.select("node", "n"), node)
    joined = connected_components(late).select(F.col("node").alias("component"), F.col("component").alias("joined"))

    # Nodes that only the late links name stand for themselves so far.
    named = known.unionAll(joined.select(F.col("component").alias("node"), "component")).distinct()
    final = named.join(joined, "component", "left").select("node", F.coalesce("joined", "component").alias("group"))
    members = final.join(classes.select("node", F.struct("doc_id", "mark", "node").alias("own")), "node")
    least = members.groupBy("group").agg(F.min("own").alias("component"))
    linked = members.join(least, "group").select("node", "component")
    return rows, classes.drop("signature", "n").join(linked, "node", "left").withColumn(
        "component", F.coalesce("component", F.struct("doc_id", "mark", "node"))
    )


def link_duplicates(docs, id_col="doc_id", text_col="text"):
    """One row per document: ``doc_id``, ``n_shingles``, ``component_id`` (the smallest
    id that can be reached, itself included) and ``kept``."""
    docs = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    rows, classes = _link(docs)
    by_digest = classes.select(F.col("digest").alias("of"), F.col("component.doc_id").alias("component"))
    out = rows.join(by_digest, (F.col("digest") == F.col("of")) & (F.col("n_shingles") > 0), "left")
    component = F.coalesce("component", "doc_id")
    return out.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.equal_null(component, F.col("doc_id")).alias("kept")
    )


def remove_near_duplicates(docs, id_col="doc_id", text_col="text"):
    """One document of each component, all columns unchanged: the one whose id names it.
    Documents without words stay, and so do rows with a NULL id; of rows with the same id
    and text one stays."""
    key, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`").cast("string")
    name, mark = free_name(docs, "kept_id"), free_name(docs, "kept_mark")
    rows, classes = _link(docs.select(key.alias("doc_id"), text.alias("text")))
    first = classes.filter("component.node = node").select("doc_id", "mark")
    kept = first.unionAll(rows.filter("n_shingles = 0 AND doc_id IS NOT NULL").select("doc_id", "mark")).distinct()
    kept = kept.select(F.col("doc_id").alias(name), F.col("mark").alias(f"{mark}_"))
    marked = docs.withColumn(mark, F.xxhash64(text))
    chosen = marked.join(kept.hint(MERGE), (key == F.col(name)) & (F.col(mark) == F.col(f"{mark}_")), "left_semi")
    return chosen.dropDuplicates([id_col, mark]).drop(mark).unionByName(docs.filter(key.isNull()))
