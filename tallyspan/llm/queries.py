"""The queries of this subpackage: each applies one operator, with production
parameters, to its whole table. SQL twins are in ``sql.py``."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspan.llm.common import table


def source_weight(source: str) -> float:
    """A source's target weight in packing: that of its domain (domain_of_source)."""
    return DOMAIN_WEIGHTS[f"d{int(hashlib.md5(source.encode()).hexdigest()[0], 16) % 4}"]


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packed to the sources' weights; when a source is used up, the others go
    on, so all documents are packed."""
    from tallyspan.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"), targets=source_weight)


def captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as captures: a fetch time from page_id, spread over two years."""
    second = F.pmod(F.col("page_id") * 86_477, F.lit(730 * 86_400))
    fetched = F.expr("timestamp_ntz'2023-01-01 00:00:00'") + F.make_dt_interval(secs=second)
    return table(spark, sf_dir, "pages").select("page_id", "url", fetched.alias("fetched"))


def list_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dated list: the named hosts below, and the hosts of pages whose md5
    starts with 0 or 1, which are listed, taken off again and, if the next digit
    is even, listed once more."""
    from tallyspan.llm.url_lists import host_of

    at = "timestamp_ntz'2023-01-01 00:00:00' + make_dt_interval(%s)"
    named = spark.createDataFrame(NAMED_ENTRIES, "key string, action string, category string, day int")
    day = lambda a, b: (F.conv(F.substring(F.md5("key"), a, 2), 16, 10).cast("int") + b)
    hosts = table(spark, sf_dir, "pages").select(host_of(F.col("url")).alias("key")).where("key is not null").distinct().where(F.substring(F.md5("key"), 1, 1).isin("0", "1"))
    even = F.substring(F.md5("key"), 2, 1).isin(*"02468ace")
    steps = F.array(
        F.struct(F.lit("add").alias("action"), F.lit("listed").alias("category"), day(3, 0).alias("day")),
        F.struct(F.lit("remove").alias("action"), F.lit("listed").alias("category"), day(5, 256).alias("day")),
        F.when(even, F.struct(F.lit("add").alias("action"), F.lit("relisted").alias("category"), day(7, 450).alias("day"))),
    )
    from_pages = hosts.select("key", F.explode(F.filter(steps, lambda x: x.isNotNull())).alias("x")).select("key", "x.action", "x.category", "x.day")
    return named.union(from_pages).select("key", "action", "category", F.expr(at % "day").alias("at"))


#: (key, action, category, day from 2023-01-01).
NAMED_ENTRIES = [
    ("cheap-pills.example.com", "add", "pharma", 30),
    ("spam-farm.example.org", "add", "spam", 0),
    ("spam-farm.example.org", "remove", "spam", 365),
    ("spam-farm.example.org", "add", "spam", 500),
    ("adult-x.example.net", "add", "adult", 10),
    ("free-bets.example.com", "add", "gambling", 90),
    ("casino-win.example.org", "add", "gambling", 100),
    ("casino-win.example.org", "remove", "gambling", 600),
    ("ads-track.example.org", "add", "tracking", 200),
]


def op2_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyspan.llm.url_lists import active_entries

    return active_entries(captures(spark, sf_dir), list_entries(spark, sf_dir), capture_id="page_id", url="url", fetched="fetched")


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyspan.llm.licenses import scan

    return scan(table(spark, sf_dir, "documents")).withColumn("score", F.round("score", 6))


def op4_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyspan.llm.media import store_and_read

    read = store_and_read(table(spark, sf_dir, "documents"))
    return read.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "n_chunks")


#: Weights of domains, and of languages within each; sources weigh alike.
DOMAIN_WEIGHTS = {"d0": 4.0, "d1": 3.0, "d2": 2.0, "d3": 1.0}
LANG_WEIGHTS = {"en": 5.0, "de": 2.0, "fr": 2.0, "es": 1.0}


def mixture_weights() -> dict[tuple[str | None, ...], float]:
    return {(d,): w for d, w in DOMAIN_WEIGHTS.items()} | {(d, x): w for d in DOMAIN_WEIGHTS for x, w in LANG_WEIGHTS.items()}


def domain_of_source():
    """Sources are dealt to the four domains by their md5."""
    return F.concat(F.lit("d"), F.conv(F.substring(F.md5("source"), 1, 1), 16, 10).cast("int") % 4)


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyspan.llm.mixing import mix

    chosen = mix(table(spark, sf_dir, "documents"), domain=domain_of_source(), weights=mixture_weights(), fraction=0.6, epochs=2)
    return chosen.select("doc_id", "lang", "source", "n_chars", "tokens", "epoch", "leaf_budget")


def op5_brown(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyspan.llm.brown import class_bigram_scores

    return class_bigram_scores(table(spark, sf_dir, "documents"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyspan.llm.langid import fit, predict

    docs = table(spark, sf_dir, "documents")
    return predict(docs, fit(docs))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyspan.llm.toxicity import fit, score

    docs = table(spark, sf_dir, "documents")
    return score(docs, fit(docs, table(spark, sf_dir, "labels")))


def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyspan.llm.minhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"), words=4)


def op10_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyspan.llm.order_minhash import compare_with_edited

    return compare_with_edited(table(spark, sf_dir, "documents"))


def op11_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyspan.llm.bpe import decode, encode

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = decode(encode(docs).select("doc_id", "ids"))
    ids = F.array_join(F.transform("ids", lambda i: i.cast("string")), ",")
    return done.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_compaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyspan.llm.compaction import written_and_compacted

    return written_and_compacted(table(spark, sf_dir, "clicks"), at="arrived_at", key="click_id", value="value")


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyspan.llm.audit import document_failures, interactions

    return interactions(document_failures(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_url_lists": op2_url_lists,
    "op3_licenses": op3_licenses,
    "op4_media": op4_media,
    "op5_brown": op5_brown,
    "op6_mixing": op6_mixing,
    "op7_language": op7_language,
    "op8_toxicity": op8_toxicity,
    "op9_minhash": op9_minhash,
    "op10_order_minhash": op10_order_minhash,
    "op11_bpe": op11_bpe,
    "op12_compaction": op12_compaction,
    "op13_filter_audit": op13_filter_audit,
}
