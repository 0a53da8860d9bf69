"""The operators as registered queries, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm import (
    decontamination,
    exact_dedup,
    fixity,
    html_extract,
    licenses,
    line_templates,
    packing,
    sentencepieces,
    simhash,
    spelling,
    substring_dedup,
    toxicity,
    whitening,
)
from tidewatch.llm.common import stored, table
from tidewatch.llm.oracles import ORACLES
from tidewatch.session import prepare

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    _QUERIES[function.__name__] = lambda spark, folder: function(prepare(spark), folder)
    return function


def llm_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def llm_oracles() -> dict[str, str]:
    return dict(ORACLES)


def tokenizer_path() -> str:
    """The public model that the contract of operator 10 names."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@query
def op1_benchmark_decontamination(spark, folder):
    return decontamination.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op2_html_extraction(spark, folder):
    return html_extract.main_text(table(spark, folder, "pages"))


@query
def op3_toxicity(spark, folder):
    return toxicity.toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op4_license_scan(spark, folder):
    return licenses.license_scan(table(spark, folder, "documents"))


@query
def op5_suffix_array_dedup(spark, folder):
    return substring_dedup.remove_repeats(table(spark, folder, "documents"))


def replicated(pages: DataFrame) -> DataFrame:
    """The index of all pages as WARC records, with the digest of the bytes that the replica has for each.

    Some of the replica's records are damaged and keep their length and offset, told by their URL.
    """
    record = fixity.warc_record(F.col("url"), F.col("html"))
    fate = F.substring(F.md5(F.coalesce("url", F.lit("")).cast("binary")), 1, 2).alias("fate")
    rows = pages.select("page_id", fate, record.alias("record"))
    held = F.when(F.col("fate").isin("00", "01"), fixity.damaged(F.col("record"))).otherwise(F.col("record"))
    return fixity.record_index(rows.withColumn("replica", F.sha2(held, 256)), F.col("record"), "page_id", "fate", "replica")


@query
def op6_warc_fixity(spark, folder):
    """All pages as WARC files, and a replica of them of which some records are damaged or lost, told by their URL."""
    index = stored(replicated(table(spark, folder, "pages")))
    replica = index.where(~F.col("fate").isin("02", "03")).select("file", "offset", F.col("replica").alias("digest"))
    found = fixity.fixity_audit(index.select("file", "offset", "digest"), replica)
    return found.join(index, ["file", "offset"]).select("page_id", "fault")


@query
def op7_exact_dedup(spark, folder):
    return exact_dedup.exact_duplicates(table(spark, folder, "documents"))


@query
def op8_simhash(spark, folder):
    return simhash.simhash_groups(table(spark, folder, "documents"), shingle=3, radius=2)


@query
def op9_line_dedup(spark, folder):
    return line_templates.line_report(table(spark, folder, "documents"))


@query
def op10_sentencepiece(spark, folder):
    return sentencepieces.encode_decode(table(spark, folder, "documents"), tokenizer_path())


@query
def op11_spelling_variants(spark, folder):
    return spelling.spelling_variants(table(spark, folder, "documents"))


@query
def op12_embedding_whitening(spark, folder):
    return whitening.whiten(table(spark, folder, "embeddings"))


def word_tokenizer_path() -> str:
    """The public tokenizer that the contract of operator 13 names."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query
def op13_packing(spark, folder):
    return packing.pack_documents(table(spark, folder, "documents"), word_tokenizer_path())
