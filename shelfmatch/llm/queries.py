"""The registered queries of this package and the SQL they are compared with, where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmatch.llm import (
    chunk_dedup, decontaminate, digest, language, license_scan, merkle, packing, periodic_runs, simhash, suffix_dedup, token_count,
    toxicity, url_filter,
)
from shelfmatch.llm.common import table
from shelfmatch.llm.merkle_sql import LOWER, UPPER, manifest_sql

#: Verdict and rule; the rule's host fits its subdomains too.
URL_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


def vocabulary_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.language_ids(table(spark, sf_dir, "documents"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.url_verdicts(table(spark, sf_dir, "pages"), URL_RULES)


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.covered(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents")).withColumn("n_spans", F.size("spans").cast("long")).drop("spans")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.withColumn("n_spans", F.size("spans").cast("long")).drop("spans")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), packing.word_count(F.col("text")))


def op7_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest.compare_with_edits(table(spark, sf_dir, "documents"))


def op8_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.token_counts(table(spark, sf_dir, "documents"), token_count.read_vocabulary(vocabulary_path()))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = suffix_dedup.repeated_spans(table(spark, sf_dir, "documents"))
    return spans.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def id_hash() -> Column:
    """crc32 of the decimal id, unsigned; null without an id."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One text in ten, told by its id, is made periodic from a place on; digests stand for runs and for what is left."""
    h = id_hash()
    g = F.floor(h / 10)
    words = periodic_runs.words_of(F.col("text"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.when(h % 10 == 0, words).alias("words"), g.alias("g"))
    n = F.size("words")
    start = (F.col("g") % n).cast("int")
    docs = docs.withColumn("start", F.when(n > 0, start)).withColumn("period", (1 + F.floor((n - F.col("start")) / (3 + F.col("g") % 8))).cast("int"))
    looped = F.array_join(periodic_runs.repeated_from(F.col("words"), F.col("start"), F.col("period")), " ")
    found = periodic_runs.periodic_runs(docs.select("doc_id", F.coalesce(F.when(F.col("start").isNotNull(), looped), "text").alias("text")))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    top = found.withColumn("top", periodic_runs.strongest(F.col("runs")))
    return top.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "top.start", "top.length", "top.period",
        F.expr("1000 * top.length div top.period").alias("exponent_milli"),
        F.sha2(F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise("")), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    lowered = F.translate("text", UPPER, LOWER)
    altered = F.when(id_hash() % 3 == 0, merkle.leaf([lowered if c == "text" else F.col(c) for c in columns]))
    found = merkle.manifest(table(spark, sf_dir, "documents"), columns, "doc_id", "lang", also={"altered": altered})
    told = merkle.checked(found, F.coalesce("altered", "leaf"))
    return told.select("doc_id", "leaf", "subroot", "root", merkle.hashed(merkle.proof(F.col("path"))).alias("proof_sha256"),
                       "folded_root", "verified")


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_dedup.exact_groups(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language": op1_language,
    "op2_url_filter": op2_url_filter,
    "op3_decontaminate": op3_decontaminate,
    "op4_license_scan": op4_license_scan,
    "op5_toxicity": op5_toxicity,
    "op6_packing": op6_packing,
    "op7_digest": op7_digest,
    "op8_token_count": op8_token_count,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_simhash": op10_simhash,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_merkle": op12_merkle,
    "op13_exact_dedup": op13_exact_dedup,
}

ORACLES = {
    "op2_url_filter": """
with parts as (
  select page_id, translate(case when strpos(url, '://') > 0 then regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*') else '' end,
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    case when strpos(url, '://') > 0 then regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*([^?#]*)', 1) else '' end as path
  from pages)
select page_id, host, path, fit as rule,
  case fit when 'net/' then 'block' when 'example.com/de/' then 'block' else 'allow' end as verdict
from (select page_id, host, path, case
  when (host = 'example.net' or ends_with(host, '.example.net')) and starts_with(path, '/en/') then 'example.net/en/'
  when (host = 'example.com' or ends_with(host, '.example.com')) and starts_with(path, '/de/') then 'example.com/de/'
  when (host = 'org' or ends_with(host, '.org')) and starts_with(path, '/fr/') then 'org/fr/'
  when (host = 'net' or ends_with(host, '.net')) and starts_with(path, '/') then 'net/' end as fit from parts)
""",
    "op12_merkle": manifest_sql(),
    "op13_exact_dedup": """
select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
  row_number() over (partition by body order by doc_id desc nulls last) = 1 as kept, sha256(body) as text_sha256
from (select doc_id, coalesce(text, '') as body from documents) window same as (partition by body)
""",
}
