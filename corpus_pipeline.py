"""The corpus pipeline: quality rules, near-duplicates, repeated passages, packing.

Every stage takes ``(spark, docs, sf_dir)`` and works on all that the stage before it kept. All but
the last return the columns of ``docs``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from vecforge.llm.minhash import near_duplicates
from vecforge.llm.packing import pack
from vecforge.llm.quality import judge
from vecforge.llm.suffix_dedup import remove_repeats
from vecforge.session import scratch_path

NEAR_PERCENT = 80   # least similarity of near-duplicates: the general rule, not op7's contract value
REPEAT_WORDS = 51   # words of the least repeated passage that goes: over 50
REPEAT_BYTES = 400  # a repeated string of as many bytes goes whatever its words are (a script may put no space between them)


def quality_rules(spark, docs, sf_dir):
    """Documents that no rule rejects. A document without text has no words and goes.

    Repeated rows and rows without an id are judged alike, row by row; an empty table gives no rows.
    """
    rows = docs.select(F.struct("*").alias("row"), "text")  # whole rows go through, whatever their columns are called
    return judge(rows, carry=["row"]).filter("kept").select("row.*")


def near_dedup(spark, docs, sf_dir):
    """One document of each group of near-duplicates, the one of least id.

    Rows that share an id are one document, of which one row stays: the one of least text (null last), of those
    the one of least hash of the other columns. Rows without an id are in no group and all stay.
    """
    path = scratch_path(spark, "pipeline-groups")
    near_duplicates(docs, percent=NEAR_PERCENT).write.parquet(path)
    groups = spark.read.parquet(path).filter("doc_id IS NOT NULL")
    gone = groups.filter("NOT kept").select("doc_id").distinct()
    repeated = groups.groupBy("doc_id").agg(F.count("*").alias("rows")).filter("rows > 1").select("doc_id")
    stay = docs.join(gone, "doc_id", "left_anti")
    if not repeated.head(1):
        return stay.select(*docs.columns)
    hashed = F.xxhash64(*[f.name for f in docs.schema.fields if "map<" not in f.dataType.simpleString()])
    first = (stay.join(repeated, "doc_id", "left_semi").groupBy("doc_id")
             .agg(F.min_by(F.struct(*docs.columns), F.struct(F.col("text").isNull(), "text", hashed)).alias("row")).select("row.*"))
    return stay.join(repeated, "doc_id", "left_anti").select(*docs.columns).unionByName(first.select(*docs.columns))


def suffix_dedup(spark, docs, sf_dir):
    """Texts without the passages of over 50 words, or of 400 bytes or more, that also stand elsewhere, and ``n_chars`` of what is left.

    Every row stays, also one whose whole text goes; a null text stays null. Rows with equal texts
    repeat each other, whatever their ids; a null id does not matter; an empty table gives no rows.
    """
    cut = remove_repeats(docs, length=REPEAT_BYTES, words=REPEAT_WORDS)
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return cut.select(*docs.columns)


def packing(spark, docs, sf_dir):
    """Pieces of all documents in sequences of 1024 ids; a document left without text is its end id.

    Rows with equal or null ids are packed one by one; an empty table gives no rows.
    """
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality_rules", quality_rules), ("near_dedup", near_dedup), ("suffix_dedup", suffix_dedup),
          ("packing", packing)]
ORACLE_SQL = None  # components, suffix sorting and tokenizing are not SQL; tests hold run() against brute force


def run(spark, sf_dir):
    """Apply the stages in order to ``documents``; what a stage keeps is written and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
