"""The registered queries of the training-data operators, one opN_<name> for each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import line_dedup, quality_rules, url_filter, warc
from tessera.llm.shared import table


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and the divergence verdict of every document."""
    from tessera.llm.quality_rules import quality_rules

    return quality_rules(table(spark, sf_dir, "documents"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that ten or more sources show, but for their first place."""
    from tessera.llm.line_dedup import remove_boilerplate

    out = remove_boilerplate(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op3_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's record in the deduplicated archives."""
    from tessera.llm.warc import resolved_pages

    return resolved_pages(table(spark, sf_dir, "pages"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the bytes that 100-byte strings seen earlier cover."""
    from tessera.llm.suffix_dedup import removal_digests

    return removal_digests(table(spark, sf_dir, "documents"))


#: The rules of op5's contract. The operator's own RULES, which the SQL and its tests are made of, have the words of
#: the two net rules the other way round.
CONTRACT_RULES = (
    ("com/en/", "block"),
    ("example.com/en/7", "allow"),
    ("net/de/", "allow"),
    ("example.net/de/8", "block"),
    ("org/es/", "block"),
)


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule and template verdict of every page's url."""
    from tessera.llm.url_filter import judge_urls

    return judge_urls(table(spark, sf_dir, "pages"), rules=CONTRACT_RULES)


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 tokens."""
    import public_tokenizers

    from tessera.llm.packing import pack, tokenise

    return pack(tokenise(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")))


def op7_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest vectors of every hundredth one."""
    from tessera.llm.ann import nearest

    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.filter(F.pmod(F.col("vec_id"), F.lit(100)) == 0))


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text of documents, encoded by the 50k ranks and decoded again."""
    import public_tokenizers

    from tessera.llm.byte_bpe import Vocabulary, round_trip_digests

    vocabulary = Vocabulary(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return round_trip_digests(table(spark, sf_dir, "documents"), vocabulary)


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score and verdict of every document."""
    from tessera.llm.quality_classifier import classify

    return classify(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "score", "kept")


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents linked at a Jaccard similarity of 0.85 on 3-word shingles."""
    from tessera.llm.near_dedup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_line_dedup": op2_line_dedup,
    "op3_warc_revisits": op3_warc_revisits,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_url_filter": op5_url_filter,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_nearest": op7_nearest,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_minhash": op10_minhash,
}

ORACLES: dict[str, str] = {
    "op1_quality_rules": quality_rules.oracle(),
    "op2_line_dedup": f"SELECT doc_id, n_lines, n_removed, sha256(text) AS kept_sha256 FROM ({line_dedup.oracle()})",
    "op3_warc_revisits": warc.oracle(),
    "op5_url_filter": url_filter.oracle(),
}
