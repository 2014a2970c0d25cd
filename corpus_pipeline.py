"""A corpus pipeline: quality rules, line dedup, near dedup, mixing, packing.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame; all but the last
give the columns of ``documents``. ``run`` writes what a stage gives to the
shared folder and hands it to the next.

A null or empty text fails the quality rules; later stages accept one all the
same. Mixing hands on whole documents, as many copies as the words taken are times the
document's size, and no source with a target is left empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from minuteflow.llm import line_dedup, mixing, near_dup, packing, quality
from minuteflow.llm.common import kept, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows that the quality rules keep, as they are.

    Null, empty and short texts go. Repeated rows are judged alike and stay repeated; null ids are
    judged by their text; very long texts are judged whole; a column ``verdict`` comes through; an
    empty table gives no rows. Documents without a row in ``labels`` are judged like others.
    """
    trusted = quality.trusted_ids(table(spark, sf_dir, "labels"))
    packed = docs.select("doc_id", "text", F.struct(*docs.columns).alias("row"))
    return quality.judged(packed, trusted).where("verdict.kept").select("row.*")


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row, its text without the lines found in ten rows or more.

    A null text becomes empty. Repeated rows count as rows of their own, null ids do no harm, very
    long texts and lines are taken whole, columns ``n_lines`` and ``n_dropped`` come through, and an
    empty table gives no rows.
    """
    others = F.struct(*(c for c in docs.columns if c != "text"))
    packed = docs.select("doc_id", "text", others.alias("row"))
    cleaned = line_dedup.dedup_lines(packed).select("row", "text")
    return cleaned.select(
        *(F.col("text") if c == "text" else F.col("row")[c].alias(c) for c in docs.columns)
    )


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: see :func:`near_dup.one_of_each`."""
    return near_dup.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole rows, as often as the mix takes them: see :func:`mixing.mixed_documents`."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every row: see :func:`packing.packed`. It hands on no columns."""
    return packing.packed(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", drop_lines),
    ("near dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack),
]

# Signatures, components, tokens and the packing search are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
