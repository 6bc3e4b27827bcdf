"""Corpus pipeline: quality filter, near-dedup, substring dedup, mixing, packing.

Each stage takes (spark, docs, sf_dir), works on all that the stage before
kept, and returns the columns of ``documents``; the last returns packed
pieces.  ``run`` applies them to ``documents`` and writes each result to the
shared folder, so that a stage reads a table and not the lineage of all
stages before it.
"""

from pyspark.sql import functions as F

from tillwise.llm import minhash, mixing, packing, quality, suffix_tree
from tillwise.llm.common import staged, table


def keep_quality(spark, docs, sf_dir):
    """Documents that the quality classifier rejects go."""
    return quality.kept_documents(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark, docs, sf_dir):
    """One document of each group of near duplicates stays (five words, 0.8)."""
    return minhash.one_of_each(docs)


def substring_dedup(spark, docs, sf_dir):
    """Words of passages that an earlier document holds go."""
    kept = suffix_tree.marked_rows(docs)
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mix_sources(spark, docs, sf_dir):
    """Documents are repeated, or left out, until sources meet their targets."""
    return mixing.mixed_rows(docs)


def pack(spark, docs, sf_dir):
    """Pieces of token ids, each with its sequence and place in it."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality", keep_quality),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("mix_sources", mix_sources),
    ("pack", pack),
]

# The classifier is a fitted model and the packing a heuristic: no SQL says
# them.  tests/llm/test_pipeline.py holds every stage against brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
