"""Keyword and vector search over text (TXT-09, TXT-10)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: English words that carry no search meaning.
STOP_WORDS = ("a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "has", "he", "in", "is", "it", "its", "of", "on", "that", "the", "to", "was", "were", "will", "with")


def tokens(text: Column, drop: Sequence[str] = ()) -> Column:
    """Lower-cased runs of letters and digits, in order."""
    found = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda t: t != "")
    return F.filter(found, lambda t: ~t.isin(*drop)) if drop else found


def postings(docs: DataFrame, id_col: str, text_col: str, drop: Sequence[str] = STOP_WORDS) -> DataFrame:
    """token, id, document length and term frequency, without stemming and positions (`textindex` has both). A document's words are counted where it is read."""
    words = docs.select(F.col(id_col).alias("id"), tokens(F.col(text_col), drop).alias("t"))
    each = words.select("id", F.size("t").alias("length"), F.explode("t").alias("token"))
    return each.groupBy("token", "id", "length").agg(F.count("*").alias("tf"))


def match_all(docs: DataFrame, id_col: str, text_col: str, words: Sequence[str]) -> DataFrame:
    """Documents that hold every word, with the summed term frequency: a filter over the scan, without a shuffle."""
    wanted = [w.lower() for w in words]
    found = docs.select(F.col(id_col), tokens(F.col(text_col)).alias("_t"))
    for w in wanted:
        found = found.where(F.array_contains("_t", F.lit(w)))
    return found.select(id_col, F.size(F.filter("_t", lambda t: t.isin(*wanted))).cast("long").alias("hits"))


def search_index(index: DataFrame, words: Sequence[str], n_docs: int, limit: int | None = None) -> DataFrame:
    """Documents with every word, ranked by tf-idf over length; reads only the words' postings."""
    wanted = sorted({w.lower() for w in words})
    rows = index.where(F.col("token").isin(*wanted))
    df = F.broadcast(rows.groupBy("token").agg(F.count("*").alias("df")))  # one row per search word
    weight = F.sum(F.col("tf") / F.col("length") * F.log(F.lit(float(n_docs)) / F.col("df") + 1))
    found = rows.join(df, "token").groupBy("id").agg(F.count("*").alias("n"), weight.alias("rank")).where(F.col("n") == len(wanted)).select("id", "rank")
    ranked = found.orderBy(F.desc("rank"), "id")
    return ranked.limit(limit) if limit else ranked


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, v: s + v)


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; null for zero vectors and for different dimensions."""
    size = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when((F.size(a) == F.size(b)) & (size > 0), dot(a, b) / size)


def cosine_top(vectors: DataFrame, id_col: str, vector_col: str, query: Sequence[float], k: int) -> DataFrame:
    """The k most similar rows to one vector: one scan and a top-k, no shuffle of vectors."""
    return vectors.select(id_col, cosine(F.col(vector_col), F.array(*(F.lit(float(x)) for x in query))).alias("similarity")).where("similarity IS NOT NULL").orderBy(F.desc("similarity"), id_col).limit(k)
