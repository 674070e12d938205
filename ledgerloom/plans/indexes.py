"""Search indexes kept in the store: vectors per profile (TXT-10), words of chunks (TXT-09).

An index is made in one commit with what it says of itself. Rows written since
are searched as they are, and rows written again replace those indexed, so a
search never waits for an index to be made anew.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import textindex, vectorindex
from ..operators.embedding import MAX_INDEXED_DIMENSION, EmbeddingError, Profile
from ..operators.search import cosine_top
from .store import Store

VECTORS, LISTS, WORDS = "chunk_vectors", "chunk_vector_lists", "chunk_words"


def _embeddings(store: Store, profile: Profile) -> DataFrame:
    return store.read("chunk_embeddings").where(F.col("profile_name") == profile.profile_name)


def index_vectors(store: Store, profile: Profile, lists: int | None = None) -> None:
    """Make the index of a profile's embeddings; only those of cosine profiles within the limit of dimensions have one."""
    if not profile.indexable:
        raise EmbeddingError(f"an index takes {MAX_INDEXED_DIMENSION} dimensions at most, not {profile.embedding_dimension}")
    if profile.distance_metric != "cosine":
        raise EmbeddingError(f"no index for {profile.distance_metric}")
    rows = _embeddings(store, profile)
    with store.commit():
        latest = rows.agg(F.max("ingest_seq")).first()[0]

        def put(name: str, df: DataFrame, by: Sequence[str]) -> DataFrame:
            return store.write_set(VECTORS if name == "vectors" else LISTS, profile.profile_name, df, by)

        if latest is not None:
            vectorindex.build(rows, "chunk_key", "embedding", put, lists)
            store.manifest()["marks"][f"vectors {profile.profile_name}"] = latest


def similar_chunks(store: Store, profile: Profile, query: Sequence[float], k: int = 10, exact: bool = False) -> DataFrame:
    """id (a chunk's key) and cosine of the k chunks most similar to a vector, in order."""
    rows, seen = _embeddings(store, profile), store.manifest()["marks"].get(f"vectors {profile.profile_name}")
    known = store.read_set(LISTS, profile.profile_name)
    if seen is None or "centroid" not in known.columns or known.isEmpty():
        return cosine_top(rows, "chunk_key", "embedding", query, k).withColumnRenamed("chunk_key", "id")
    newer = rows.where(F.col("ingest_seq") > seen)
    index = store.read_set(VECTORS, profile.profile_name).join(newer.select(F.col("chunk_key").alias("id")), "id", "left_anti")
    found = vectorindex.search(index, vectorindex.read_lists(known), query, k, exact=exact)
    more = cosine_top(newer, "chunk_key", "embedding", query, k).withColumnRenamed("chunk_key", "id")
    return found.unionByName(more).orderBy(F.desc("similarity"), "id").limit(k)


def index_words(store: Store, buckets: int = textindex.BUCKETS) -> None:
    """Make the index of the words of all chunks."""
    with store.commit():
        rows = textindex.index_rows(store.read("periodic_chunks"), "chunk_key", "chunk_text", buckets)
        store.write_set(WORDS, f"by {buckets}", rows.hint("rebalance", "bucket").sortWithinPartitions("bucket", "token", "id"), ["bucket"])


def chunks_with(store: Store, text: str, limit: int = 20, as_phrase: bool = False, buckets: int = textindex.BUCKETS) -> DataFrame:
    """Chunks that hold every word of `text`, or the phrase, best first."""
    index = store.read_set(WORDS, f"by {buckets}")
    if as_phrase:
        return textindex.phrase(index, text, buckets).orderBy(F.desc("hits"), "id").limit(limit)
    return textindex.ranked(index, text, store.read("periodic_chunks").count(), limit, buckets)
