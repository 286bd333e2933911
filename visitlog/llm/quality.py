"""Quality rules with thresholds learnt per language and source.

Four rates describe a text: symbols and repeated lines and repeated words per
word, and the mean length of its words. For each group of language and source a
mergeable quantile sketch (KLL) of each rate is built, map-side first, so a
source that holds a third of the rows sends one sketch per task. Sketches of the
groups are merged into one per language and one over all.

A threshold is where the tail of a rate breaks off. Going up the ranks ``RANKS`` of a
sketch, the first step that is more than ``reach`` times as long as all the way from the
median to where it begins separates texts of another kind; the threshold is its middle.
Without such a step nothing is: the threshold lies beyond the largest value. So where
the threshold lies follows from the group alone; ``units`` only say below which width a
group counts as constant. A text fails where a rate lies beyond the thresholds of its
group and of its language; a group of fewer than ``min_rows`` rows has only the
language's, a language of fewer only that over all. The thresholds, one row per group,
are joined to the rows.

Defined cases: NULL text has no words and fails the base rule; NULL language or
source is a group of its own; repeated rows are judged alike; an empty table
gives no rows; other columns pass through :func:`filter_quality` unchanged.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitlog.llm.frames import bounded_batches, free_name
from visitlog.llm.words import SAME, SPACES, byte_set, hash_words, mix, row_slices, sums_between, text_bytes
from visitlog.session import stage

SYMBOLS = byte_set(*[(ord(c), ord(c)) for c in "#*$%&|<>"])
BLANKS = " \t\n\x0b\x0c\r"
MIN_WORDS = 50
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
RATES = ("symbols", "lines", "repeats", "length")
# The median, and the ranks between which the tail may break off.
RANKS = (0.5, 0.85, 0.9, 0.92, 0.94, 0.96, 0.98, 0.99, 0.995, 1.0)
# The least distance from the median that counts, so that ties are no tail.
UNITS = {"symbols": 0.02, "lines": 0.01, "repeats": 0.05, "length": 0.25}
REACH = 3.0
MIN_ROWS = 100
SKETCH_K = 200


def measure(column):
    """The five counts of each text of an Arrow column, as five integer arrays."""
    parts = [[np.zeros(0, np.int64)] for _ in MEASURES]
    for begin, end in row_slices(column):
        texts = column.slice(begin, end - begin)
        data, offsets = text_bytes(texts)
        hashes, bounds, _, _ = hash_words(data, offsets, SPACES, SAME)
        chars = ((data & 0xC0) != 0x80) & ~SPACES[data]
        values = (
            np.diff(bounds),
            sums_between(chars, offsets),
            sums_between(SYMBOLS[data], offsets),
            np.fromiter(map(_dup_lines, texts.to_pylist()), np.int64, len(texts)),
            _repeat_words(hashes, bounds),
        )
        for part, value in zip(parts, values):
            part.append(value)
    return [np.concatenate(p).astype(np.int64) for p in parts]


def _dup_lines(text):
    if not text or "\n" not in text:
        return 0
    lines = [x for x in text.split("\n") if x.strip(BLANKS)]
    return len(lines) - len(set(lines))


def _repeat_words(hashes, bounds):
    """Words of each text that lie in a 3-word window found twice or more in it."""
    if len(hashes) < 3:
        return np.zeros(len(bounds) - 1, np.int64)
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    inside = np.flatnonzero(text[:-2] == text[2:])
    keys = mix(hashes[inside] + mix(hashes[inside + 1] + mix(hashes[inside + 2] + text[inside].astype(np.uint64))))
    order = np.argsort(keys)
    same = keys[order][1:] == keys[order][:-1]
    twice = np.zeros(len(keys), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(hashes), bool)
    for k in range(3):
        covered[inside[twice] + k] = True
    return sums_between(covered, bounds)


def with_measures(docs, text_col="text", name="measures"):
    """``docs`` with a struct of the five counts; narrow."""
    bounded_batches(docs)
    kind = T.StructType([T.StructField(m, T.LongType()) for m in MEASURES])
    schema = T.StructType([*docs.schema.fields, T.StructField(name, kind)])

    def task(batches):
        for batch in batches:
            values = measure(batch.column(batch.schema.get_field_index(text_col)))
            struct = pa.StructArray.from_arrays([pa.array(v) for v in values], list(MEASURES))
            yield pa.RecordBatch.from_arrays([*batch.columns, struct], [*batch.schema.names, name])

    return docs.mapInArrow(task, schema)


def rates(m):
    """The rates of a struct of counts, NULL without words."""
    return {
        "symbols": F.try_divide(m["n_symbols"], m["n_words"]),
        "lines": F.try_divide(m["n_dup_lines"], m["n_words"]),
        "repeats": F.try_divide(m["n_repeat_words"], m["n_words"]),
        "length": F.try_divide(m["word_chars"], m["n_words"]),
    }


def base_failed(m):
    return (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > 50 * m["n_words"])


def fence(values, unit, reach=REACH):
    """Where the tail breaks off, from an array column of the quantiles at ``RANKS``."""
    at = [F.element_at(values, i + 1) for i in range(len(RANKS))]
    width = [F.greatest(x - at[0], F.lit(unit)) for x in at]
    found = at[-1] + reach * width[-1]
    for i in reversed(range(1, len(RANKS) - 1)):
        found = F.when(at[i + 1] - at[i] > reach * width[i], (at[i] + at[i + 1]) / 2).otherwise(found)
    return found


def thresholds(measured, lang, source, m, reach=REACH, units=UNITS, min_rows=MIN_ROWS, k=SKETCH_K):
    """One row per language and source: the highest allowed rates, and the range
    of mean word lengths. Only texts that pass the base rule are learnt from."""
    passed = measured.filter(~base_failed(m)).select(
        lang.alias("lang"), source.alias("source"), *[v.alias(n) for n, v in rates(m).items()]
    )
    sketched = stage(
        passed.groupBy("lang", "source").agg(
            F.count(F.lit(1)).alias("n"), *[F.kll_sketch_agg_double(r, F.lit(k)).alias(r) for r in RATES]
        ),
        "sketches",
    )

    def merged(*keys):
        return sketched.groupBy(*keys).agg(
            F.sum("n").alias("n"), *[F.kll_merge_agg_double(r, F.lit(k)).alias(r) for r in RATES]
        )

    def fences(sketches, prefix):
        """Upper limits of all rates, and the lower one of lengths, as negative numbers."""
        out = [F.col("n").alias(f"{prefix}n")]
        for rate in RATES:
            for side, sign in (("max", 1), ("min", -1)):
                if side == "max" or rate == "length":
                    ranks = [r if sign > 0 else 1 - r for r in RANKS]
                    at = F.array(*[sign * F.kll_sketch_get_quantile_double(rate, F.lit(r)) for r in ranks])
                    out.append(at.alias(f"{prefix}{side}_{rate}"))
        keys = [c for c in ("lang", "source") if c in sketches.columns]
        # An empty sketch has no quantiles.
        quantiles = stage(sketches.filter("n > 0").select(*keys, *out), "quantiles")
        limits = [c for c in quantiles.columns if c not in keys and not c.endswith("_n") and c != "n"]
        return quantiles.select(
            *keys, f"{prefix}n", *[fence(F.col(c), units[c.rpartition("_")[2]], reach).alias(c) for c in limits]
        )

    own, by_lang, every = fences(sketched, ""), fences(merged("lang"), "lang_"), fences(merged(), "all_")
    by_lang = by_lang.withColumnRenamed("lang", "its_lang")
    # The row over all is a scalar subquery.
    together = own.join(by_lang, own["lang"].eqNullSafe(by_lang["its_lang"])).withColumn(
        "every", every.select(F.struct("*")).scalar()
    )
    limits = []
    for name in [f"max_{r}" for r in RATES] + ["min_length"]:
        larger = F.when(F.col("lang_n") >= min_rows, F.col(f"lang_{name}")).otherwise(F.col("every")[f"all_{name}"])
        limit = F.when(F.col("n") >= min_rows, F.greatest(F.col(name), larger)).otherwise(larger)
        limits.append((limit if name.startswith("max") else -limit).alias(name))
    return stage(together.select("lang", "source", *limits), "thresholds")


def verdict(m, limit):
    """Whether the rates lie within the limits; a group without limits keeps all."""
    r = rates(m)
    fine = [r[x] <= limit[f"max_{x}"] for x in RATES] + [r["length"] >= limit["min_length"]]
    out = F.lit(True)
    for f in fine:
        out = out & F.coalesce(f, F.lit(True))
    return ~base_failed(m) & out


def _judged(measured, lang, source, m, limits):
    """Join the limits of each row's group; Spark broadcasts them only below its
    own threshold, since the staged table has a known size."""
    group = F.struct(F.col("lang").alias("limit_lang"), F.col("source").alias("limit_source"), F.struct(
        *[F.col(c) for c in limits.columns if c not in ("lang", "source")]).alias("limit"))
    name = free_name(measured, "group")
    limits = limits.select(group.alias(name))
    joined = measured.join(
        limits, lang.eqNullSafe(F.col(name)["limit_lang"]) & source.eqNullSafe(F.col(name)["limit_source"]), "left"
    )
    return joined, verdict(m, F.col(name)["limit"]), name


def quality_report(docs, id_col="doc_id", text_col="text", lang_col="lang", source_col="source", **options):
    """One row per document: the counts, the base rule and the verdict.

    The counts are staged, without texts, before sketches and join read them."""
    rows = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"),
        F.col(f"`{lang_col}`").cast("string").alias("lang"), F.col(f"`{source_col}`").cast("string").alias("source"),
    )
    measured = stage(with_measures(rows).drop("text"), "measures")
    lang, source, m = F.col("lang"), F.col("source"), F.col("measures")
    limits = thresholds(measured, lang, source, m, **options)
    joined, kept, _ = _judged(measured, lang, source, m, limits)
    return joined.select("doc_id", "measures.*", base_failed(m).alias("base_failed"), kept.alias("kept"))


def filter_quality(docs, text_col="text", lang_col="lang", source_col="source", **options):
    """The documents that pass, all columns unchanged.

    The texts are measured twice, once for the sketches and once for the filter:
    that costs less than moving or storing them."""
    name = free_name(docs, "measures")
    measured = with_measures(docs, text_col, name)
    lang, source = F.col(f"`{lang_col}`").cast("string"), F.col(f"`{source_col}`").cast("string")
    m = F.col(name)
    learnt = stage(measured.select(lang.alias("lang"), source.alias("source"), m.alias("measures")), "measures")
    limits = thresholds(learnt, F.col("lang"), F.col("source"), F.col("measures"), **options)
    joined, kept, group = _judged(measured, lang, source, m, limits)
    return joined.filter(kept).drop(name, group)
