"""From raw documents to packed training windows, stage by stage.

Each stage works on all documents its predecessor kept: texts of low quality go,
one document of each group of near duplicates stays, documents that hold benchmark
passages go, personal data and secrets get surrogates, and what is left is packed
into windows. Each result is written to the shared folder and read again, so a
lost executor repeats one stage at most.

Defined cases, by stage: NULL or empty text has no words and fails the quality rules; the
later stages, given such rows, keep them (near duplicates and decontamination) or leave them
as they are (surrogates), and pack them with length 0. A NULL id, language or source is a
value like any other; rows with a NULL id are never dropped as copies, and of rows with one
id and text one stays. Other columns, of any name, pass through all stages but the last. An
empty table gives an empty table of the same columns after each stage.
"""

from pyspark.sql import functions as F

from visitlog.llm.decontaminate import remove_contaminated
from visitlog.llm.neardup import remove_near_duplicates
from visitlog.llm.packing import pack_documents
from visitlog.llm.pii import remove_pii
from visitlog.llm.quality import filter_quality
from visitlog.session import stage


def quality(spark, docs, sf_dir):
    """Documents within the rules' thresholds, learnt from these documents."""
    return filter_quality(docs)


def near_duplicates(spark, docs, sf_dir):
    """One document of each group."""
    return remove_near_duplicates(docs)


def decontaminate(spark, docs, sf_dir):
    """Documents without any benchmark window."""
    return remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def surrogates(spark, docs, sf_dir):
    """All documents, with surrogates for personal data; ``n_chars`` follows the text."""
    safe = remove_pii(docs)
    if "n_chars" not in docs.columns:
        return safe
    kind = docs.schema["n_chars"].dataType
    return safe.withColumn("n_chars", F.length("text").cast(kind))


def pack(spark, docs, sf_dir):
    """A row for each piece of a document, with its window and place in it."""
    return pack_documents(docs)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("surrogates", surrogates),
    ("pack", pack),
]

# No SQL: components, quantile sketches, keyed surrogates and packing.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
