"""Language identification by compression.

Each language has a raw-content dictionary: labelled texts one after another. A
text is compressed once with every dictionary, and the language whose dictionary
gives the smallest result is chosen; the margin is how much larger the next one
is, relative to it. Where the margin is narrow the choice is marked as rejected.

The dictionaries are the only thing that is learnt, from a bounded sample: for each
language the ``per_language`` labelled rows with the smallest hash of their id and text.
Each gives an equal part of the dictionary's ``dictionary_bytes`` (less where there are
more languages than ``ALL_BYTES`` holds): the whole text, if it is that short, else
stretches of it at even distances from its beginning to its end, so that a long text
teaches all its parts alike. Every text is predicted whole, in lower case.

Defined cases: text that is NULL or has no letter is ``und`` with score 0; rows
with a NULL language are never learnt from; without labelled rows all are
``und``; repeated rows are judged alike; an empty table gives no rows.
"""

import pyarrow as pa
import zstandard
from pyspark.sql import Window
from pyspark.sql import functions as F

from visitlog.llm.frames import bounded_batches

UNKNOWN = "und"
PER_LANGUAGE = 400
DICTIONARY_BYTES = 1 << 17
# Dictionaries of all languages together reach every task; more languages than
# fit get smaller ones.
ALL_BYTES = 32 << 20
# A fast level, whose size depends most on what the dictionary holds.
LEVEL = -1
NARROW = 0.01
# Characters of one stretch of a long text.
STRETCH = 80


def spread(text, most):
    """About ``most`` characters of a text column, in stretches spread over all of it."""
    n = max(1, most // STRETCH)
    size, length = most // n, F.length(text)
    step = (length - size) / max(1, n - 1)
    stretches = F.transform(
        F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.substring(text, F.floor(i * step).cast("int") + 1, F.lit(size))
    )
    return F.when(length <= most, text).otherwise(F.array_join(stretches, " "))


def learn_dictionaries(labelled, per_language=PER_LANGUAGE, dictionary_bytes=DICTIONARY_BYTES):
    """``{language: dictionary bytes}`` from a frame of ``doc_id``, ``text``, ``lang``."""
    usable = labelled.filter("lang IS NOT NULL AND text IS NOT NULL AND text != ''")
    sizes = usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()
    if not sizes:
        return {}
    # The rows wanted are among those with a hash below a bound that about four times
    # as many pass, however large the language is: only those are shuffled.
    shares = F.create_map(*[F.lit(x) for r in sizes for x in (r.lang, min(1.0, 4 * per_language / r.n))])
    place = F.shiftrightunsigned(F.xxhash64("doc_id", "text"), 11) / float(1 << 53)
    size = min(dictionary_bytes, ALL_BYTES // len(sizes))
    each = max(1, size // per_language)
    few = usable.select("lang", "doc_id", place.alias("place"), spread(F.col("text"), each).alias("text")).filter(
        F.col("place") <= shares[F.col("lang")]
    )
    order = Window.partitionBy("lang").orderBy("place", "doc_id", "text")
    first = few.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= per_language)
    rows = first.select("lang", "nth", "text").collect()
    texts = {}
    for row in sorted(rows, key=lambda r: (r.lang, r.nth)):
        texts.setdefault(row.lang, []).append(row.text.lower().encode("utf-8", "replace"))
    return {lang: b"\n".join(parts)[:size] for lang, parts in texts.items()}


class CompressionClassifier:
    def __init__(self, dictionaries, level=LEVEL):
        self.languages = sorted(dictionaries)
        self.compressors = []
        for lang in self.languages:
            content = zstandard.ZstdCompressionDict(dictionaries[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            content.precompute_compress(level=level)
            plain = zstandard.ZstdCompressor(
                dict_data=content, level=level, write_content_size=False, write_checksum=False, write_dict_id=False
            )
            self.compressors.append(plain.compress)

    def classify(self, text):
        """``(language, score, margin)`` of one text."""
        if not text or not self.languages or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0, 0.0
        data = text.lower().encode("utf-8", "replace")
        sizes = [len(compress(data)) for compress in self.compressors]
        best = min(range(len(sizes)), key=sizes.__getitem__)
        others = [s for i, s in enumerate(sizes) if i != best]
        if not others:
            return self.languages[best], 1.0, 1.0
        margin = (min(others) - sizes[best]) / sizes[best]
        return self.languages[best], margin / (margin + NARROW), margin


def identify(docs, dictionaries, text_col="text"):
    """A struct column's worth of ``lang_pred``, ``score`` and ``rejected`` per row,
    beside the columns of ``docs`` but the text; narrow."""
    bounded_batches(docs)
    kept = [f for f in docs.schema.fields if f.name != text_col]
    schema = docs.select(*[f"`{f.name}`" for f in kept]).schema
    for name, kind in (("lang_pred", "string"), ("score", "double"), ("rejected", "boolean")):
        schema = schema.add(name, kind)

    def task(batches):
        model = CompressionClassifier(dictionaries)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_col)).to_pylist()
            judged = [model.classify(t) for t in texts]
            arrays = [batch.column(batch.schema.get_field_index(f.name)) for f in kept]
            arrays += [
                pa.array([j[0] for j in judged], pa.string()),
                pa.array([j[1] for j in judged], pa.float64()),
                pa.array([j[2] < NARROW for j in judged], pa.bool_()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, schema.names)

    return docs.mapInArrow(task, schema)


def predict_languages(docs, id_col="doc_id", text_col="text", lang_col="lang"):
    """One row per document. A third of the documents, by the checksum of their id,
    is held out from learning; language and source are no input of a prediction."""
    doc_id = F.col(f"`{id_col}`")
    held_out = F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))
    rows = docs.select(doc_id.alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"),
                       held_out.alias("held_out"))
    labelled = docs.filter(~held_out).select(
        doc_id.alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"),
        F.col(f"`{lang_col}`").cast("string").alias("lang"),
    )
    return identify(rows, learn_dictionaries(labelled))
