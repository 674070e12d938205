"""An English inverted index with positions: built once, stored by token, searched without reading texts (TXT-09).

Words are lower-cased runs of letters and digits, cut to their stem by the first
step of Porter's algorithm (plurals, past forms, gerunds, final y), which takes
off what inflection adds and leaves derivation alone; y counts as a vowel.
Stop words are left out but keep their places, so phrases go across them. The
stem is a Column expression and runs inside code generation.

A row of the index is a token's places in one document. Rows lie in buckets by a
hash of the token and are sorted by it, so a search reads the buckets of its own
words, and of those the row groups that may hold them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .search import STOP_WORDS, tokens

BUCKETS = 64
_VOWEL = "[aeiouy]"


def stem(word: Column) -> Column:
    """Porter's first step."""
    bare = F.regexp_replace(F.regexp_replace(word, "(ss|i)es$", "$1"), "([^s])s$", "$1")

    def shorter(by: int) -> Column:
        return F.left(bare, F.length(bare) - by)

    def mended(cut: Column) -> Column:
        last = F.right(cut, F.lit(1))
        twice = (last == F.left(F.right(cut, F.lit(2)), F.lit(1))) & (F.length(cut) > 1) & ~last.rlike("[aeiouylsz]")
        return F.when(cut.rlike("(at|bl|iz)$"), F.concat(cut, F.lit("e"))).when(twice, F.left(cut, F.length(cut) - 1)).when(cut.rlike("^[^aeiouy]+[aeiouy][^aeiouywx]$"), F.concat(cut, F.lit("e"))).otherwise(cut)

    eed = F.when(bare.rlike(f"{_VOWEL}[^aeiouy].*eed$"), shorter(1)).otherwise(bare)
    plain = F.when(F.endswith(bare, F.lit("eed")), eed).when(bare.rlike(f"{_VOWEL}.*ed$"), mended(shorter(2))).when(bare.rlike(f"{_VOWEL}.*ing$"), mended(shorter(3))).otherwise(bare)
    return F.regexp_replace(plain, f"({_VOWEL}.*)y$", "$1i")


def placed(docs: DataFrame, id_col: str, text_col: str, drop: Sequence[str] = STOP_WORDS) -> DataFrame:
    """id, length, token and position of every word but stop words; the length counts all words."""
    words = docs.select(F.col(id_col).alias("id"), tokens(F.col(text_col)).alias("w"))
    each = words.select("id", F.size("w").alias("length"), F.posexplode("w").alias("position", "word"))
    kept = each.where(~F.col("word").isin(*drop)) if drop else each
    return kept.select("id", "length", stem(F.col("word")).alias("token"), "position")


def bucket_of(token: Column, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(token), F.lit(buckets)).cast("int")


def index_rows(docs: DataFrame, id_col: str, text_col: str, buckets: int = BUCKETS) -> DataFrame:
    """bucket, token, id, length, positions: to be written partitioned by bucket. Words of a document are gathered where it is read."""
    each = placed(docs, id_col, text_col).groupBy("token", "id", "length").agg(F.array_sort(F.collect_list("position")).alias("positions"))
    return each.withColumn("bucket", bucket_of(F.col("token"), buckets))


def write_index(docs: DataFrame, id_col: str, text_col: str, path: str, buckets: int = BUCKETS) -> None:
    """A common token's rows may be many: buckets are dealt out by size, not one to a task."""
    rows = index_rows(docs, id_col, text_col, buckets).hint("rebalance", "bucket")
    rows.sortWithinPartitions("bucket", "token", "id").write.option("compression", "zstd").partitionBy("bucket").parquet(path)


def asked(spark: SparkSession, text: str) -> list[tuple[str, int]]:
    """Tokens of a search and their places."""
    found = placed(spark.createDataFrame([(0, text)], "id int, text string"), "id", "text").orderBy("position").collect()
    return [(r.token, r.position) for r in found]


def rows_of(index: DataFrame, words: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """The index's rows of some tokens: a filter on buckets and one on tokens, both of which reach the scan."""
    spark = index.sparkSession
    own = [r.b for r in spark.createDataFrame([(w,) for w in words], "w string").select(bucket_of(F.col("w"), buckets).alias("b")).collect()] if words else []
    return index.where(F.col("bucket").isin(sorted(set(own))) & F.col("token").isin(sorted(set(words))))


def ranked(index: DataFrame, text: str, documents: int, limit: int | None = None, buckets: int = BUCKETS) -> DataFrame:
    """Documents with every word of `text`, ranked by frequency over length, weighted by rarity; none for a text of stop words."""
    words = sorted({t for t, _ in asked(index.sparkSession, text)})
    rows = rows_of(index, words, buckets)
    rarity = rows.groupBy("token").agg(F.log(F.lit(float(documents)) / F.count("*") + 1).alias("rarity"))  # a row a word
    weight = F.sum(F.size("positions") / F.col("length") * F.col("rarity"))
    found = rows.join(F.broadcast(rarity), "token").groupBy("id").agg(F.count("*").alias("n"), weight.alias("rank")).where(F.col("n") == len(words)).select("id", "rank")
    return found.orderBy(F.desc("rank"), "id").limit(limit) if limit else found


def phrase(index: DataFrame, text: str, buckets: int = BUCKETS) -> DataFrame:
    """Documents that hold the words of `text` at the distances they have there, and how often."""
    places: dict[str, list[int]] = {}
    for token, position in asked(index.sparkSession, text):
        places.setdefault(token, []).append(position)
    if not places:
        return index.select("id", F.lit(0).cast("bigint").alias("hits")).limit(0)
    offsets = F.create_map(*(x for t, at in places.items() for x in (F.lit(t), F.array(*map(F.lit, at)))))
    rows = rows_of(index, list(places), buckets).select("id", "positions", F.explode(F.element_at(offsets, F.col("token"))).alias("offset"))
    starts = rows.select("id", F.explode("positions").alias("p"), "offset").groupBy("id", (F.col("p") - F.col("offset")).alias("start")).agg(F.count("*").alias("n"))
    return starts.where(F.col("n") == sum(map(len, places.values()))).groupBy("id").agg(F.count("*").alias("hits"))
