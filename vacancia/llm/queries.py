"""Registered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

import string
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vacancia import session
from vacancia.llm import (
    bpe, chat, collocations, license_scan, merkle, oracles, packing, partenum, perplexity, rff_quality, superkmers, syncmers,
    token_rollup, url_filter,
)
from vacancia.llm.common import stored
from vacancia.llm.order import placed

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Versions of the token counts: documents begin with the first and move to the second.
ROLLUP_VERSIONS = ("byte_bpe_50k", "byte_bpe_multi_50k")

#: The rules of the URL query.
URL_RULES = (
    ("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"), ("com", "/de/", "block"))


@query("op1_url_filter", f"""
    WITH rules(r_host, r_path, r_verdict) AS (VALUES {", ".join(map(str, URL_RULES))}),
    parts AS (
        SELECT page_id,
               translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
                         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
               regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
        FROM pages),
    best AS (
        SELECT host, path, max({{'n': length(r_host || r_path), 'v': r_verdict, 'r': r_host || r_path}}) AS m
        FROM (SELECT DISTINCT host, path FROM parts)
        JOIN rules ON (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path)
        GROUP BY host, path)
    SELECT page_id, host, path, m.r AS rule, coalesce(m.v, 'allow') AS verdict
    FROM parts LEFT JOIN best USING (host, path)""")
def op1(spark, sf_dir):
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge(pages, rules).select("page_id", "host", "path", "rule", "verdict")


@query("op2_syncmers")
def op2(spark, sf_dir):
    return syncmers.compare(table(spark, sf_dir, "documents"))


@query("op3_perplexity_rules")
def op3(spark, sf_dir):
    return perplexity.judge(table(spark, sf_dir, "documents"))


def held_out(doc_id: str = "doc_id"):
    """Rows that labels are never learned from."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1


def quality_model(spark, docs: DataFrame, sf_dir) -> dict | None:
    return rff_quality.fit(
        docs.filter(~F.coalesce(held_out(), F.lit(True))), table(spark, sf_dir, "labels"), "quality")


@query("op4_quality_classifier")
def op4(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    scored = rff_quality.score(docs, quality_model(spark, docs, sf_dir))
    return scored.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", "predicted")


@query("op5_byte_bpe")
def op5(spark, sf_dir):
    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    encoded = bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), path, pattern)
    return bpe.decode(encoded, path, pattern).select(
        "doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op6_token_rollup")
def op6(spark, sf_dir):
    """All documents arrive, odd ids move to the second tokenizer, then copies are deleted."""
    first, second = ROLLUP_VERSIONS
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang").withColumn(
        "digest", F.sha2(F.coalesce("text", F.lit("")), 256))
    counted = stored(token_rollup.count_tokens(
        docs, {v: public_tokenizers.path(f"{v}.tiktoken") for v in ROLLUP_VERSIONS}, public_tokenizers.PATTERN), "counts")
    state = lambda version: F.struct(
        "source", "lang", version.alias("version"), F.col("tokens")[version].alias("tokens"))
    now = F.when(F.col("doc_id") % 2 == 1, F.lit(second)).otherwise(F.lit(first))
    nothing = F.lit(None).cast("struct<source:string,lang:string,version:string,tokens:bigint>")
    load = counted.select(nothing.alias("old"), state(F.lit(first)).alias("new"))
    move = counted.filter("doc_id % 2 = 1").select(state(F.lit(first)).alias("old"), state(F.lit(second)).alias("new"))
    # All go and one of each text returns: sums of tasks meet, no row joins its copies.
    kept = counted.groupBy("digest").agg(F.min_by(F.struct("doc_id", "source", "lang", "tokens"), "doc_id").alias("k")).select("k.*")
    copies = counted.select(state(now).alias("old"), nothing.alias("new")).unionByName(
        kept.select(nothing.alias("old"), state(now).alias("new")))
    rollup = token_rollup.Rollup(spark, session.scratch_path(spark, "rollup"))
    for batch, changes in (("load", load), ("move", move), ("load", load), ("copies", copies), ("move", move)):
        rollup.commit(batch, changes)
    rollup.fold()
    return rollup.totals()


@query("op7_partenum_join")
def op7(spark, sf_dir):
    return partenum.link(table(spark, sf_dir, "documents").select("doc_id", "text"), w=3, percent=90)


@query("op8_best_fit_packing")
def op8(spark, sf_dir):
    return pack_documents(table(spark, sf_dir, "documents"))


def pack_documents(docs: DataFrame) -> DataFrame:
    items = packing.pieces(
        docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN, capacity=2048)
    return packing.pack(items, capacity=2048).select(
        "doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32",
        "sequence_id", "offset")


@query("op9_superkmer_dedup")
def op9(spark, sf_dir):
    return superkmers.dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op10_license_scan")
def op10(spark, sf_dir):
    return license_scan.scan(table(spark, sf_dir, "documents")).drop("spans")


@query("op11_collocations", oracles.COLLOCATIONS)
def op11(spark, sf_dir):
    return collocations.mine(table(spark, sf_dir, "documents"))


@query("op12_merkle_manifest", oracles.MANIFEST)
def op12(spark, sf_dir):
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    docs = table(spark, sf_dir, "documents")
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    rows = docs.select("doc_id", "lang", merkle.digest(*fields, F.col("text")).alias("leaf"),
                       F.when(tampered, merkle.digest(*fields, lowered)).alias("tampered"))
    proved = merkle.prove(merkle.build(rows, "lang", "doc_id"))
    folded = merkle.fold(F.coalesce("tampered", "leaf"), "proof")
    return proved.select(
        "doc_id", "leaf", "subroot", "root", merkle.siblings_digest("proof").alias("proof_sha256"),
        folded.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))


#: Fixed value: both texts of the conversation that the contract adds.
CONTROL_TEXT = "</s>[INST] ok [/INST]"


@query("op13_chat_trees", oracles.CHAT)
def op13(spark, sf_dir):
    """Every conversation is a tree of one branch: each turn replies to the one before."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(
        spark.createDataFrame([(-1, 0, "user", CONTROL_TEXT), (-1, 1, "assistant", CONTROL_TEXT)],
                              "conv_id long, turn long, role string, text string"))
    replies = placed(rows, "conv_id", F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")).withColumn(
        "parent", F.when(F.col("place") > 0, F.col("place") - 1))
    formatted = chat.format_trees(replies, "conv_id", "place", "parent", score=None)
    turns = F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n")))
    return chat.parsed(formatted).select(
        F.col("tree").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.concat_ws("", turns), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))
