"""A training corpus from raw documents: language, near-duplicates, personal data, mixture, token ids.

Each stage takes ``(spark, docs, sf_dir)`` and works on every row of ``docs``,
which is what the stage before it kept, stored as Parquet and read again. All
but the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridframe.llm import bpe, langid, mixing, pii, setsketch
from gridframe.llm.queries import PIECES, RANKS
from gridframe.llm.shipping import ship
from gridframe.operators.extent import checkpoint_dir

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
# A document stays if its language is at least this certain; clean text is far above it.
LEAST_SCORE = 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without letters and those whose language stays uncertain; fills a null language.

    The model learns from the labelled rows that are not held out. Where no row
    has a label there is no language to tell, and documents with a letter stay.
    """
    ship(spark)
    model = langid.fit(docs.filter(~langid.held_out(F.col("doc_id"))), public_tokenizers.path(PIECES))
    judged = langid.predict(docs.select(*COLUMNS), model)
    sure = (F.col("lang_pred") != langid.UNDETERMINED) & (F.col("score") >= LEAST_SCORE)
    if not model.languages:
        return docs.select(*COLUMNS).filter(F.col("text").rlike(r"\p{L}"))
    return judged.filter(sure).withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, that of the smallest id; shingles of five words, similarity 0.8.

    Of rows equal in id and text one stays, with the least source, language and size, nulls first. Documents without an id are in groups
    like all others; one of them stays where no document of the group has an id.
    """
    ship(spark)
    found = setsketch.judged(docs)
    # An id that may be null as two columns that are not, so that joining and grouping share one shuffle of the texts.
    named = lambda name: [F.col(name).isNull().alias("no_id"), F.coalesce(F.col(name), F.lit(0)).alias("some_id")]
    key = ["no_id", "some_id", "t1", "t2"]
    gone = found.filter(~F.col("kept")).select(*named("id"), "t1", "t2").distinct()
    keyed = docs.select(*COLUMNS, *named("doc_id"), *setsketch.text_key(F.col("text")))
    rest = F.min(F.struct("source", "lang", "n_chars")).alias("rest")
    left = keyed.join(gone, key, "left_anti").groupBy(*key, "text").agg(rest)
    doc_id = F.when(~F.col("no_id"), F.col("some_id")).alias("doc_id")
    return left.select(doc_id, "text", "rest.*").select(*COLUMNS)


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data gives way to surrogates; ``n_chars`` follows the text where it changed."""
    ship(spark)
    done = pii.replace_entities(docs.select(*COLUMNS))
    length = F.when(F.size("pii_spans") > 0, F.char_length("text").cast("bigint")).otherwise(F.col("n_chars"))
    return done.withColumn("n_chars", length).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, sorted by training position."""
    ship(spark)
    key = ["doc_id", "order"]
    # Equal rows are told apart by number, so each of them gets copies of its own.
    number = F.row_number().over(Window.partitionBy(*key).orderBy(*key))
    mixed = mixing.mix(docs).filter("copies > 0").withColumn("no", number).select(*key, "no", F.explode("positions").alias("position"))
    mixed = mixed.toDF("__id", "__order", "__no", "position")
    rows = docs.select(*COLUMNS).withColumn("order", mixing.order_of(F.col("doc_id"), F.col("text"))).withColumn("no", number)
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("order") == F.col("__order")) & (F.col("no") == F.col("__no"))
    return rows.join(mixed, same).orderBy("position", "doc_id").select(*COLUMNS)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with digests of the ids and of the bytes they decode to."""
    ship(spark)
    ranks = public_tokenizers.path(RANKS)
    # One pass holds one Python worker in each task; two chained ones held two.
    coded = bpe.encode_decode(docs.select("doc_id", "source", "text"), ranks, public_tokenizers.PATTERN)
    digests = [F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")]
    return coded.select("doc_id", "source", bpe.token_count(F.col("ids")).alias("n_tokens"), "ids", *digests)


STAGES = [
    ("language_id", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("surrogates", replace_personal_data),
    ("mixture", mix_sources),
    ("token_ids", encode_tokens),
]

# Language scores, registers, keyed permutations and merges are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each keeps is stored in the shared folder."""
    folder = f"{checkpoint_dir(spark)}/corpus-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
