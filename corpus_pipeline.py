"""The corpus pipeline: toxicity, exact copies, near copies, mixture, packing.

Each stage reads what the one before it kept; all but the last return the columns of documents. Whoever runs the
stages writes each result as Parquet and reads it again; ``run`` does so in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.llm import dedup_exact, mixing, ngram_join, packing, toxicity
from millrace.llm.common import held_out, load
from millrace.session import settle


def drop_toxic(spark, docs, sf_dir):
    """Documents that score as toxic go; the examples are the labelled rows that op4 may learn from, too."""
    labels = load(spark, sf_dir, "labels").filter(~held_out(F.col("doc_id"), 4, 2))
    return toxicity.drop_toxic(docs, toxicity.fit(docs, labels))


def drop_copies(spark, docs, sf_dir):
    """One row of each group of equal texts stays, the one with the largest id."""
    return dedup_exact.drop_copies(docs)


def drop_near_copies(spark, docs, sf_dir):
    """One document of each group of similar texts stays, the one with the smallest id."""
    return ngram_join.keep_one_of_each(docs)


def mix_sources(spark, docs, sf_dir):
    """Each document as often as its source's target takes it."""
    return mixing.mix(docs)


def pack_sequences(spark, docs, sf_dir):
    """Pieces of documents in sequences of 1024 tokens."""
    return packing.pack(docs, with_ids=False)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("ngram_jaccard", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# Byte-pair tokens, toxicity scores and near-duplicate components have no SQL form.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over the documents; each result but the last is written to the shared folder and read again."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
