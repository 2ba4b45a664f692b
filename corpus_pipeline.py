"""The document pipeline: rules, near duplicates, repeated passages, benchmark items, piece ids.

Each stage takes ``(spark, docs, folder of tables)`` and returns a DataFrame, which is written as Parquet
and read again as the next stage's ``docs``. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boxloom.llm.columns import packed, unpacked
from boxloom.llm.decontaminate import contained_items
from boxloom.llm.minhash import near_duplicates
from boxloom.llm.pieces import encode_pieces
from boxloom.llm.quality_rules import apply_rules
from boxloom.llm.scratch import removed, written
from boxloom.llm.suffix_dedup import cut_repeats


def _slim(docs: DataFrame) -> tuple[DataFrame, list]:
    """``text``, ``doc_id`` and all else packed, so that operators' results clash with no column; and how to get them back."""
    passed, row = packed(docs, [], "text")
    return docs.select(row.alias("row"), "doc_id", "text"), unpacked(passed, "row", "text", F.col("text"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a quality rule rejects go.

    Null and empty texts fail the rules; repeated rows are judged alike; no rows give no rows.
    """
    rows, columns = _slim(docs)
    return apply_rules(rows).where("kept").select(*columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (Jaccard 0.8 on five-word shingles) stays.

    It is the one of the smallest id; of repeated rows one stays. Null and wordless texts are no
    duplicates of anything and stay; no rows give no rows.
    """
    rows, columns = _slim(docs)
    return near_duplicates(rows, percent=80).where("chosen").select(*columns)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of over 50 words, and strings of 400 bytes, that occur elsewhere are cut out; documents left without a word go.

    ``n_chars`` follows a cut. Repeated rows are each other's copies; null, empty and short texts stay as
    they are; no rows give no rows.
    """
    rows, columns = _slim(docs)
    found = cut_repeats(rows, length=400, words=51).where(r"NOT was_cut OR text RLIKE '[^\\x20\\x09-\\x0D]'")
    length = F.when(F.col("was_cut"), F.char_length("text").cast("bigint")).otherwise(F.col("row.n_chars"))
    columns[docs.columns.index("n_chars")] = length.alias("n_chars")
    return found.select(*columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item (0.8 of its five-word shingles or more) go.

    Null and wordless texts contain none and stay; repeated rows go or stay together; no rows give no rows.
    """
    rows, columns = _slim(docs)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return contained_items(rows, items, percent=80).where(F.size("contained") == 0).select(*columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of what is left, checked by decoding; null for a null text, none for an empty one. Every row stays."""
    rows, _ = _slim(docs)
    return encode_pieces(rows).select("doc_id", "row.lang", "row.source", "row.n_chars", "n_ids", "ids", "decoded_same")


STAGES = [
    ("quality rules", quality),
    ("near duplicates", near_dedup),
    ("repeated passages", repeats),
    ("benchmark items", decontaminate),
    ("piece ids", encode),
]

#: SQL cannot express the stages' methods; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before: list[DataFrame] = []
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
        removed(*before)  # what a stage has written is not read after the next one
        before = [docs]
    return STAGES[-1][1](spark, docs, sf_dir)
