"""Corpus pipeline: quality rules, line dedup, near-dedup, decontamination, mixing.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before
kept. The last one gives, per document left, its size, its source's size and target, and
the words that the mix takes of it.

Defined cases: null and blank texts and texts of under 50 words go in the first stage; equal rows are one document
from near-dedup on; null sources are one source; null languages one language; all stages but the last keep extra
columns, whatever their names; an empty table gives an empty result.
"""
from __future__ import annotations

from dockline import session
from dockline.llm import common, decontaminate, linedup, mixing, neardup, quality


def quality_rules(spark, docs, sf_dir):
    return quality.keep(docs)


def line_dedup(spark, docs, sf_dir):
    return linedup.remove_lines(docs)


def near_dedup(spark, docs, sf_dir):
    return neardup.keep_one(docs)


def benchmark_decontamination(spark, docs, sf_dir):
    return decontaminate.drop_leaking(docs, common.table(spark, sf_dir, "benchmark"))


def mix_sources(spark, docs, sf_dir):
    return mixing.mix(docs).taken()


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near-dedup", near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("mixing", mix_sources),
]
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over ``documents``, each one's result written and read again."""
    session.prepare(spark)
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.materialize(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
