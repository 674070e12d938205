"""Driver queries of the corpus operators, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, fold
from .mixing import Plan


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def toxicity_model(spark: SparkSession, docs: DataFrame, sf_dir: str):
    """A model learned from the labels outside the held-out fold."""
    from .toxicity import fit

    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(fold(F.col("doc_id"), 4) != 2)
    return fit(docs, labels)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import score

    docs = documents(spark, sf_dir)
    scored = score(docs, toxicity_model(spark, docs, sf_dir))
    return scored.select("doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


#: Target weights of the mixture; sources are numbered, and every fourth belongs to one domain.
MIXTURE = Plan(
    domains={"web": 0.4, "reference": 0.3, "forum": 0.2, "news": 0.1, "other": 0.05},
    languages={"en": 0.5, "de": 0.2, "fr": 0.2, "es": 0.1, "other": 0.05},
    sources={**{f"src{i}": 1.0 for i in range(20)}, "other": 0.5},
)


def source_domain() -> Column:
    number = F.expr("try_cast(regexp_extract(source, '^src([0-9]+)$', 1) AS int)")
    return F.element_at(F.array(*(F.lit(d) for d in ("web", "reference", "forum", "news"))), (number % 4 + 1).cast("int"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import mix

    docs = documents(spark, sf_dir).select("doc_id", "text", "lang", "source")
    return mix(docs, MIXTURE, source_domain()).select(F.col("c0").alias("doc_id"), "domain", "lang", "source", "n_tokens", "epoch", "taken")


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .licenses import scan

    return scan(documents(spark, sf_dir))


def op4_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .lm_score import lm_scores

    return lm_scores(documents(spark, sf_dir), fold(F.col("doc_id"), 5) == 1)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack

    return pack(documents(spark, sf_dir), tokenizer("word_bpe_49k.json"), capacity=2048, end_id=1)


def op6_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_store import token_store

    return token_store(documents(spark, sf_dir), tokenizer("byte_bpe_50k.json"), end_id=0)


def op7_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .ann import nearest_neighbours

    return nearest_neighbours(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("id") % 100 == 0, k=10)


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pii import personal_data

    return personal_data(documents(spark, sf_dir))


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .near_dedup import near_duplicates

    return near_duplicates(documents(spark, sf_dir), words=4, distance=4).drop("text_hash")


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .exact_dedup import exact_duplicates

    return exact_duplicates(documents(spark, sf_dir))


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_counts import token_counts

    return token_counts(documents(spark, sf_dir), tokenizer("byte_bpe_50k.json"), limit=1024)


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with faults put in by a checksum of conversation and turn: rows dropped, emptied, cut, repeated or given to the user."""
    known = rows.select("conv_id", "turn", *(F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")))
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    drawn = known.withColumn("_damage", F.crc32(key.cast("binary")) % 20).where("_damage <> 0")
    text = F.when(F.col("_damage") == 1, "").when(F.col("_damage") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    twice = F.explode(F.when(F.col("_damage") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return drawn.select("conv_id", "turn", F.when(F.col("_damage") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), twice.alias("_copy")).drop("_copy")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .conversations import EMPTY_SHA256, repair_digests, turns_of

    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    found = repair_digests(turns_of(damaged(rows)))
    all_ids = rows.select("conv_id").distinct()
    counts = [F.coalesce(c, F.lit(0)).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return all_ids.join(found, F.col("conv_id").eqNullSafe(F.col("conv")), "left").select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(EMPTY_SHA256)).alias("repaired_sha256"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .whitening import whiten

    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), k=4)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_toxicity, op2_mixing, op3_licenses, op4_lm_score, op5_packing, op6_token_store, op7_ann, op8_pii, op9_near_dedup, op10_exact_dedup, op11_token_counts, op12_conversation_repair, op13_whitening)}


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def oracle_sql() -> dict[str, str]:
    return {
        "op10_exact_dedup": f"""
            WITH t AS (SELECT doc_id, {_LOWER} AS norm FROM documents),
                 g AS (SELECT doc_id, norm, max(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size FROM t)
            SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM g
        """,
    }
