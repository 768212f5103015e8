"""The registered queries over the given tables, one per operator."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenmill.llm.bwt_dedup import remove_repeats
from tokenmill.llm.common import table
from tokenmill.llm.decontaminate import benchmark_overlap
from tokenmill.llm.divergence import source_divergence
from tokenmill.llm.fertility import token_quality
from tokenmill.llm.language_id import identify
from tokenmill.llm.license_scan import license_scan
from tokenmill.llm.pieces import decode_ids, encode_texts
from tokenmill.llm.poisson_mix import poisson_mix
from tokenmill.llm.preference import preference_rows, swapped_replies
from tokenmill.llm.secret_scan import KINDS, secret_scan
from tokenmill.llm.simhash_gray import near_duplicates
from tokenmill.llm.url_rules import judge_urls
from tokenmill.llm.vector_codes import vector_codes
from tokenmill.session import cut_lineage


def op1_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = license_scan(table(spark, folder, "documents"))
    words, labels = F.col("places.word"), F.col("places.label")
    both = F.concat(labels, F.col("blocks.label"))
    score = F.when(F.size("places") > 0, F.lit(1.0)).otherwise(
        F.coalesce(F.array_max("blocks.containment"), F.lit(0.0))
    )
    return found.select(
        "doc_id",
        "n_words",
        F.size("places").cast("bigint").alias("n_base"),
        F.array_min(words).alias("first_word"),
        F.array_max(words).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(labels)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(both)), ",").alias("labels"),
        score.alias("score"),
    )


def op2_token_fertility(spark: SparkSession, folder: str) -> DataFrame:
    return token_quality(table(spark, folder, "documents"))


def op4_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = secret_scan(table(spark, folder, "documents"))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind):
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("bigint")

    base = F.filter("secrets", lambda s: s["kind"] != "random")
    return found.select(
        "doc_id",
        *(count(kind).alias(f"n_{kind}") for kind in KINDS),
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("secrets")).alias("spans"),
    )


#: Host, path and verdict of the rules that the pages are judged by.
URL_RULES = """
values ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
as rules(host, path, verdict)
"""


def op3_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.sql(f"select * from {URL_RULES}")
    pages = table(spark, folder, "pages").select("page_id", "url")
    return judge_urls(pages, rules).select("page_id", "host", "path", "rule", "verdict")


def op5_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    found = benchmark_overlap(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op6_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return identify(table(spark, folder, "documents"))


def op7_simhash_gray(spark: SparkSession, folder: str) -> DataFrame:
    found = near_duplicates(table(spark, folder, "documents"))
    return found.select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def op8_poisson_mix(spark: SparkSession, folder: str) -> DataFrame:
    mixed = poisson_mix(table(spark, folder, "documents"))
    return mixed.select("doc_id", "source", "text", "copy", "mix_key")


def op9_preference_format(spark: SparkSession, folder: str) -> DataFrame:
    return preference_rows(swapped_replies(table(spark, folder, "conversations")))


def op10_bwt_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = remove_repeats(table(spark, folder, "documents"))
    lengths = F.transform("spans", lambda s: s["end"] - s["start"])
    return found.select(
        "doc_id",
        "n_bytes",
        F.aggregate(lengths, F.lit(0).cast("bigint"), lambda a, b: a + b).alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op11_piece_codes(spark: SparkSession, folder: str) -> DataFrame:
    coded = encode_texts(table(spark, folder, "documents"))
    spelled = F.array_join(F.transform("ids", lambda i: i.cast("string")), ",")
    named = coded.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), F.sha2(spelled, 256).alias("ids_sha256"), "ids")
    decoded = decode_ids(named, keep=("doc_id", "n_tokens", "ids_sha256"))
    return decoded.select("doc_id", "n_tokens", "ids_sha256", F.sha2("text", 256).alias("decoded_sha256"))


def op12_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return source_divergence(table(spark, folder, "documents"))


def op13_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    found, books = vector_codes(table(spark, folder, "embeddings"), keep=("label",))
    found = cut_lineage(found)
    totals = cut_lineage(found.groupBy("label").agg(F.sum("error").alias("label_error")))
    entries = ",".join(str(value) for book in books for entry in book.tolist() for value in entry)
    return found.join(totals, found["label"].eqNullSafe(totals["label"])).select(
        "vec_id",
        F.array_join(F.transform("code", lambda e: F.lower(F.lpad(F.hex(e), 2, "0"))), "").alias("code"),
        "error",
        "label_error",
        F.lit(hashlib.sha256(entries.encode()).hexdigest()).alias("codebooks_sha256"),
    )


QUERIES = {
    "op1_license_scan": op1_license_scan,
    "op2_token_fertility": op2_token_fertility,
    "op3_url_rules": op3_url_rules,
    "op4_secret_scan": op4_secret_scan,
    "op5_decontaminate": op5_decontaminate,
    "op6_language_id": op6_language_id,
    "op7_simhash_gray": op7_simhash_gray,
    "op8_poisson_mix": op8_poisson_mix,
    "op9_preference_format": op9_preference_format,
    "op10_bwt_dedup": op10_bwt_dedup,
    "op11_piece_codes": op11_piece_codes,
    "op12_source_divergence": op12_source_divergence,
    "op13_vector_codes": op13_vector_codes,
}
