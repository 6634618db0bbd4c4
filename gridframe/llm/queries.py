"""One query per operator over the whole of its table, and SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridframe.llm import bpe, chat, collocations, covertree, filter_audit, kmeans_tree, langid, mixing, oracles, pii, quality, secret_scan, setsketch, url_filter
from gridframe.llm.shipping import ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = dict(oracles.SQL)

RANKS = "byte_bpe_50k.tiktoken"
PIECES = "piece_bpe_32k.model"


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """Register a query under its function's name."""

    @wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return function(spark, sf_dir)

    QUERIES[function.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document's text, and the bytes they decode to, as digests."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ranks = public_tokenizers.path(RANKS)
    coded = bpe.decode(bpe.encode(docs, ranks, public_tokenizers.PATTERN), ranks)
    return coded.select(
        "doc_id",
        bpe.token_count(F.col("ids")).alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learnt from the rows that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.fit(docs.filter(~langid.held_out(F.col("doc_id"))), public_tokenizers.path(PIECES))
    judged = langid.predict(docs.drop("lang"), model)
    return judged.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query
def op10_setsketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of near-duplicate documents, three-word shingles, similarity 0.85."""
    found = setsketch.near_duplicates(table(spark, sf_dir, "documents"), width=3, percent=85)
    return found.withColumnRenamed("id", "doc_id")


@query
def op3_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 highest inner products of every hundredth vector with all others."""
    return covertree.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


@query
def op8_kmeans_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest vectors found for every fiftieth vector, by cosine."""
    return kmeans_tree.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@query
def op4_chat_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of all conversations, read back from their formatted text."""
    planted = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", planted), (-7, 1, "assistant", planted)], "conv_id bigint, turn bigint, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(extra)
    return chat.digests(chat.format_conversations(rows.withColumn("parts", chat.text_part(F.col("text")))))


@query
def op7_blob_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document: counts and digest of the base kinds, and all spans."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ledger, paths = secret_scan.scan(docs, path="doc_id")
    found = secret_scan.findings(paths, ledger)
    base = F.filter("spans", lambda s: s["kind"].isin(*[rule.kind for rule in secret_scan.BASE_RULES]))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    return found.select(
        F.col("path").alias("doc_id"),
        *[count(rule.kind) for rule in secret_scan.BASE_RULES],
        F.sha2(secret_scan.span_text(base), 256).alias("base_sha256"),
        secret_scan.span_text(F.col("spans")).alias("spans"),
    )


URL_RULES = (
    url_filter.UrlRule("allow", "com", "/"),
    url_filter.UrlRule("block", "example.com", "/en/"),
    url_filter.UrlRule("allow", "www.example.com", "/en/"),
    url_filter.UrlRule("block", "net", "/es/"),
    url_filter.UrlRule("block", "net", "/fr/"),
)


@query
def op9_path_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's URL, by rule or by its host's templates."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict", "template")


@query
def op5_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document, in the order of training."""
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    first = F.coalesce(F.get("positions", F.lit(0)), F.lit(2.0))
    return mixed.orderBy(first, "source", "doc_id").select("doc_id", "size", "source_size", "target", "taken", "copies", "positions")


@query
def op6_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its personal data replaced."""
    return pii.replace_entities(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op11_covariance_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of every document and whether it stays, by base rules and by its group's robust estimate."""
    found = quality.judged(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance")


@query
def op12_counting_bloom(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove of every language's documents, in all orders."""
    return filter_audit.audit(filter_audit.mask_counts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


@query
def op13_branch_and_bound(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's 2000 best phrases."""
    return collocations.collocations(table(spark, sf_dir, "documents"))
