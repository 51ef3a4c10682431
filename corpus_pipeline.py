"""The corpus pipeline: quality, boilerplate lines, near duplicates, repeated passages, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read
again as the next one's docs. All but the last return the columns of documents, n_chars being the
length of the text that is left. Other columns of docs go, whatever their names; an empty table gives
an empty one; texts may be of any length. Null ids, languages and sources stay null.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.line_dedup import remove_boilerplate
from tessera.llm.near_dedup import near_duplicates
from tessera.llm.packing import pack, tokenise
from tessera.llm.quality_classifier import classify
from tessera.llm.shared import write_table
from tessera.llm.suffix_dedup import kept_bytes, remove_repeats

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Near duplicates of the pipeline: shingles of five words, a Jaccard similarity of 0.8 or more.
NEAR = {"size": 5, "similarity": 80, "collections": 14, "rows": 3}


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps, unchanged. Null and blank texts go; rows that share an id are judged each."""
    return classify(docs).filter("kept").select(*COLUMNS)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that many sources show, but for each line's first place.

    No row goes. Null texts stay null, a null source isn't counted; of ties the smaller id's line stays.
    """
    return remove_boilerplate(docs).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one of the smallest id, of each group of near duplicates.

    Of rows that share that id and have words the one of the smallest text stays. Rows without an id or
    without words all stay.
    """
    near = near_duplicates(docs, **NEAR)
    some = near.filter("n_shingles > 0 and doc_id is not null").groupBy("doc_id", "kept").agg(F.count(F.lit(1)).alias("n"))
    gone = write_table(some.filter("NOT kept OR n > 1").select(F.col("doc_id").alias("id"), "kept"), "gone")
    wordy = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    out = docs.join(gone, (F.col("doc_id") == F.col("id")) & wordy, "left_anti").select(*COLUMNS)
    again = gone.filter("kept")
    if again.isEmpty():
        return out
    rows = docs.filter(wordy).join(again, F.col("doc_id") == F.col("id"), "left_semi")
    first = Window.partitionBy("doc_id").orderBy("text", "lang", "source")
    return out.unionByName(rows.withColumn("_at", F.row_number().over(first)).filter("_at = 1").select(*COLUMNS))


def passage_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of 100 bytes or more that start earlier too.

    A character that loses some of its bytes goes whole. No row goes; null texts become empty.
    """

    def finish(text: bytes, spans: list[tuple[int, int]]) -> dict:
        left = kept_bytes(text, spans).decode(errors="ignore")
        return {"text": left, "n_chars": len(left)}

    schema = pa.schema([("text", pa.string()), ("n_chars", pa.int64())])
    return remove_repeats(docs, finish, schema, carry=("lang", "source")).select(*COLUMNS)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 2048 tokens. A null text is an empty one; each row is packed."""
    import public_tokenizers

    return pack(tokenise(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES = [
    ("quality_classifier", quality_stage),
    ("line_dedup", line_stage),
    ("minhash_near_dedup", near_stage),
    ("suffix_dedup", passage_stage),
    ("best_fit_packing", packing_stage),
]

#: The classifier, the hashes of the tokenizer and the packing have no SQL form; tests/llm holds
#: run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, on documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = write_table(docs, name)
    return docs
