"""A training corpus from raw documents: STAGES, each over all rows that the stage before it kept.

1. *quality rules*: documents that the rules reject go.
2. *line dedup*: lines found in three documents or more stay in one; a document left without a line goes on
   with an empty text.
3. *SimHash near-dedup*: of each group one document stays, that of the smallest id.
4. *mixing*: each source gives its target number of words; a document comes back once for each pass that takes
   words of it, and documents that the mix leaves out go. Words keep the blanks and line breaks after them.
5. *pieces*: encodes and decodes what is left. The result has the piece ids and says whether decoding gave the
   text back.

All stages but the last return the columns of ``documents``; ``n_chars`` follows the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm.common import table
from tidewell.llm.line_dedup import drop_repeated_lines, keep_documents
from tidewell.llm.mixing import mixed_documents
from tidewell.llm.pieces import round_trip
from tidewell.llm.quality_rules import judge_documents
from tidewell.llm.simhash import near_duplicates
from tidewell.session import shared_dir


def _with_text(rows: DataFrame, text: Column) -> DataFrame:
    """The columns of ``row`` with another text, and its length."""
    return keep_documents(rows.withColumn("kept_text", text), n_chars=F.length(text).cast("long"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return judge_documents(docs).filter("kept").select("row.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _with_text(drop_repeated_lines(docs), F.col("kept_text"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_duplicates(docs).filter("stays").select("row.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _with_text(mixed_documents(docs), F.col("kept_text"))


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = ["doc_id", "lang", "source", "text_sha256"]
    marked = docs.withColumn("text_sha256", F.sha2(F.col("text").cast("binary"), 256))
    decoded = F.sha2(F.col("text").cast("binary"), 256)
    alike = decoded.eqNullSafe(F.col("row.text_sha256")).alias("decoded_alike")
    return round_trip(marked, carry=kept).select("row.*", "ids", alike)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", near_dedup),
    ("mixing sources", mix_sources),
    ("SentencePiece", pieces),
]

#: The rules' histograms, fingerprints and draws are not SQL; tests compare each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written, and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = shared_dir(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
