"""The operators on the test tables, with equivalent SQL where it can express them."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lanewise.llm import bpe, chat, filters, idcoder, langid, neardup, packing, quality, secrets, toxicity, vectors, whitening, winnow
from lanewise.llm.common import crc32_of, documents, held_out, vocabulary_file
from lanewise.llm.sql import CHAT_SQL, FILTERS_SQL, QUALITY_SQL
from lanewise.session import shared_dir

Build = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Build] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Build], Build]:
    def register(build: Build) -> Build:
        QUERIES[name] = build
        if sql is not None:
            SQL[name] = sql
        return build

    return register


@query("op1_token_id_coder")
def token_id_coder(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_dir(spark)}/ids-{uuid.uuid4().hex}"
    docs = documents(spark, sf_dir).select("doc_id", "text")
    idcoder.write(docs, vocabulary_file("byte_bpe_50k.json"), path)
    return idcoder.read(spark, path)


@query("op2_byte_bpe")
def byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    table = bpe.Table.of(bpe.read_ranks(vocabulary_file("byte_bpe_multi_50k.tiktoken")))
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return bpe.digested(bpe.encoded(docs, table, public_tokenizers.PATTERN).drop("text"), table)


@query("op3_toxicity")
def toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    scored = toxicity.score(docs, toxicity.train(docs, labels), "score")
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@query("op4_secret_scans")
def secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    found = secrets.scan(docs).drop("text")
    count = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in secrets.BASE_KINDS],
        F.sha2(secrets.listed(F.col("secrets"), secrets.BASE_KINDS), 256).alias("base_sha256"),
        secrets.listed(F.col("secrets")).alias("spans"),
    )


@query("op5_chat_formatting", CHAT_SQL)
def chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    turns = (
        spark.read.parquet(f"{sf_dir}/conversations.parquet")
        .select("conv_id", "turn", "role", "text")
        .unionByName(
            spark.createDataFrame(
                [(-7, 0, "user", said), (-7, 1, "assistant", said)],
                "conv_id long, turn long, role string, text string",
            )
        )
    )
    return chat_digest(chat.examples(turns))


def chat_digest(formatted: DataFrame) -> DataFrame:
    """Per conversation: what its formatted examples say when read back."""
    by_conversation = formatted.groupBy("conv_id").agg(
        F.max(F.when(F.col("example") == F.col("n_examples"), F.col("text"))).alias("whole"),
        F.array_sort(
            F.collect_list(
                F.struct(
                    "example",
                    chat.trainable(F.col("text"), F.col("loss_start"), F.col("loss_length")).alias("loss"),
                )
            )
        ).alias("losses"),
        F.sum(F.length("text").cast("long")).alias("formatted_chars"),
    )
    read = by_conversation.select(
        "conv_id",
        chat.parse(F.col("whole")).alias("turns"),
        F.array_join(F.transform("losses", lambda x: x["loss"]), "").alias("loss"),
        "formatted_chars",
    )
    spoken = F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(spoken, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )


@query("op6_minhash_near_dedup")
def minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return neardup.near_duplicates(docs, neardup.Forest(words=2, similarity=80))


@query("op7_packing")
def sequence_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    pieces = packing.packed(docs, vocabulary_file("word_bpe_49k.json"))
    return pieces.select(
        "doc_id", "start", "length", crc32_of("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@query("op8_quality_rules", QUALITY_SQL)
def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(documents(spark, sf_dir).select("doc_id", "text"))
    measured = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    q = F.col("quality")
    base_failed = (q["n_words"] < 50) | (100 * q["n_repeat_words"] > 50 * q["n_words"])
    return judged.select(
        "doc_id",
        *[q[n].alias(n) for n in measured],
        base_failed.alias("base_failed"),
        (~base_failed & q["kept"]).alias("kept"),
    )


@query("op9_language_id")
def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    named = langid.predict(docs.select("doc_id", "text"), langid.train(docs), "lang_pred", "score")
    return named.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query("op10_embedding_near_dedup")
def embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return vectors.near_duplicates(table, vectors.Cells(similarity=0.93))


@query("op11_filter_interactions", FILTERS_SQL)
def filter_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "source")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality", "toxic")
    return filters.interactions(filters.combinations(docs, labels))


@query("op12_document_fingerprints")
def document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    compared = winnow.against_next(documents(spark, sf_dir).select("doc_id", "text"))
    return compared.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        "near_edited",
        "near_next",
    )


@query("op13_embedding_whitening")
def embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
