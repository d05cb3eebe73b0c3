"""Registered queries of this package: (spark, folder of tables) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumetry.session import shared_folder

from . import (
    cover_tree,
    decontamination,
    fixity,
    licenses,
    near_duplicates,
    packing,
    periodic,
    prefix_trie,
    quality,
    sharding,
    substrings,
    token_counts,
    token_files,
)
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


@query
def op1_retrieval_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), with_ids=False).drop("ids")


@query
def op2_merkle_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An audit of a replica of the pages' archive in which some records were damaged: by a changed character (1 of 97
    pages, by a checksum of the id), or by a loss of content that left blanks (1 of 97)."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    chance = F.crc32(F.col("page_id").cast("string").cast("binary")) % 97
    flipped = F.concat(F.when(F.substring("html", 1, 1) == "#", "%").otherwise("#"), F.expr("substring(html, 2)"))
    lost = F.expr("repeat(' ', octet_length(html))")
    damaged = F.when((chance == 0) & (F.length("html") > 0), flipped).when(chance == 1, lost).otherwise(F.col("html"))
    return fixity.audit(fixity.records(pages), fixity.records(pages.withColumn("html", damaged)))


@query
def op3_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "group_id", (F.col("doc_id") == F.col("group_id")).alias("kept"))


@query
def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = quality.scores(docs, quality.learn(docs, table(spark, sf_dir, "labels")))
    predicted = (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted")
    return scored.select("doc_id", quality.held_out().alias("held_out"), "score", predicted)


@query
def op5_gear_chunking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text without repeats, with the number of words taken out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = substrings.deduplicated(docs)
    repeated = F.col(substrings.REMOVED) > 0
    return done.select("doc_id", "text", substrings.REMOVED, repeated.alias("repeated"), substrings.SPANS)


@query
def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


@query
def op7_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_tree.near_duplicates(table(spark, sf_dir, "embeddings"))


@query
def op8_extendible_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shards(table(spark, sf_dir, "documents"))


@query
def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_folder(spark)}/tokens"
    token_files.write_tokens(table(spark, sf_dir, "documents"), path)
    return token_files.document_digests(spark, path)


@query
def op10_fm_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.occurrences(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def with_periodic_ends(docs: DataFrame) -> DataFrame:
    """doc_id and text, where one of ten texts goes on, from some word to its end, with a few words said again and again.

    With h the checksum of the doc_id's text and g = h div 10, these are texts with h % 10 = 0: each word i >= a becomes
    word a + (i - a) % p, where n is their number, a = g % n and p = 1 + (n - a) div (3 + g % 8). A text without words, or
    without a doc_id, stays.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(f"({periodic.WORD.pattern})")))
    rows = docs.select("doc_id", "text", words.alias("words"), F.expr("crc32(binary(string(doc_id))) DIV 10").alias("g"))
    rows = rows.withColumn("n", F.size("words")).withColumn("a", F.expr("CASE WHEN n > 0 THEN g % n END"))
    rows = rows.withColumn("p", F.expr("1 + (n - a) DIV (3 + g % 8)"))
    ends = F.expr("transform(words, (w, i) -> if(i < a, w, words[int(a + (i - a) % p)]))")
    return rows.select("doc_id", F.when(F.col("n") > 0, F.array_join(ends, " ")).otherwise(F.col("text")).alias("text"))


@query
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.periodic_runs(with_periodic_ends(table(spark, sf_dir, "documents")))
    # The longest run; of equal ones the first, then that of the smallest period.
    top = F.expr("array_max(transform(runs, r -> struct(r.length AS length, -r.start AS start, -r.period AS period)))")
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    return found.withColumn("top", top).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("top.start")).alias("start"),
        F.col("top.length").alias("length"),
        (-F.col("top.period")).alias("period"),
        F.expr("1000 * top.length DIV -top.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations")).drop("text_conv_id", "text_turn")


@query
def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"))
