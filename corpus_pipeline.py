"""A corpus pipeline: each stage works on what the one before it kept.

Every stage takes documents and gives documents; the last gives their token ids. ``run`` writes the
rows of each stage to the shared folder and reads them again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tripmill.llm import toxicity
from tripmill.llm.common import staged, table
from tripmill.llm.decontaminate import find_contamination
from tripmill.llm.line_dedup import dedup_lines
from tripmill.llm.pieces import decode_pieces, encode_pieces
from tripmill.llm.simhash import near_duplicates

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
CARRIED = COLUMNS[1:]


def _documents(rows: DataFrame) -> DataFrame:
    return rows.select(F.col("id").alias("doc_id"), "carried.*").select(*COLUMNS)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the severity model rejects go; it is fitted on the labels of the stage's own
    documents."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return _documents(toxicity.predict(docs, model, carry=CARRIED).where(~F.col("toxic")))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines repeated in three or more documents stay in one; ``n_chars`` follows the text.

    A text without such lines stays as it is, null included.
    """
    kept = dedup_lines(docs, carry=CARRIED)
    changed = F.col("n_dropped") > 0
    return kept.select(
        F.col("id").alias("doc_id"),
        F.when(changed, F.col("text")).otherwise(F.col("carried.text")).alias("text"),
        "carried.lang", "carried.source",
        F.when(changed, F.length("text")).otherwise(F.col("carried.n_chars")).alias("n_chars"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near-duplicates one document stays, the one with the smallest id."""
    return _documents(near_duplicates(docs, carry=CARRIED).where("first"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    found = find_contamination(docs, table(spark, sf_dir, "benchmark"), carry=CARRIED)
    return _documents(found.where(F.col("n_hit") == 0))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document, with the text they decode to."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    found = decode_pieces(encode_pieces(docs, model, carry=["lang", "source"]), model)
    return found.select(F.col("id").alias("doc_id"), F.col("decoded").alias("text"),
                        "carried.lang", "carried.source",
                        F.size("ids").cast("bigint").alias("n_tokens"), "ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("pieces", encode),
]

# Models and hashes of the stages have no SQL form; tests compare the run with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each one's rows written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
