"""Embedding backfill (TXT-14): candidates, vectors in lots that survive an interrupted run, upsert, run log."""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict
from datetime import datetime, timezone

from pyspark.sql import functions as F

from ..operators.embedding import MAX_INDEXED_DIMENSION, EmbeddingError, Profile, Provider, Selection, candidates, embed, upsert_profile
from ..operators.upsert import clock
from ..schemas import ddl
from ..scratch import scratch_path
from .indexes import LISTS, VECTORS, index_vectors
from .store import Store


def _log(store: Store, run_id: str, profile: Profile, chosen: Selection, status: str, started: datetime, counts: dict[str, int], error: str | None = None) -> None:
    now = datetime.now(timezone.utc).replace(tzinfo=None)
    filters = json.dumps({k: str(v) for k, v in asdict(chosen).items() if v is not None}, sort_keys=True)
    row = (run_id, profile.profile_name, status, filters, None, *(counts.get(k, 0) for k in ("candidates", "embedded", "skipped", "failed")), started, None if status == "running" else now, error, int(now.timestamp() * 1e6))
    store.upsert("embedding_runs", store.spark.createDataFrame([row], ddl("embedding_runs")))


def set_profile(store: Store, profile: Profile, seq: int) -> None:
    """Store the profile; where its settings changed, its embeddings go, in the same commit, and no other profile's files are touched (SNK-15)."""
    with store.commit():
        profiles, changed = upsert_profile(store.read("embedding_profiles"), profile, seq)
        store.write("embedding_profiles", profiles)
        if changed:
            for table in ("chunk_embeddings", PENDING, VECTORS, LISTS):
                store.drop_first(table, profile.profile_name)
            store.manifest()["marks"].pop(f"vectors {profile.profile_name}", None)


#: Chunks that are sent to the service between two commits: a run that is cut off loses no more than that.
LOT = 32_768
PENDING = "embeddings_pending"


def _fold(store: Store, profile: Profile) -> None:
    """Vectors that were committed lot by lot join the profile's embeddings, in one commit that forgets the lots."""
    names = [n for n in store.manifest()["tables"].get(PENDING, {"folders": {}})["folders"] if n.rpartition(".")[0] == profile.profile_name]
    if names:
        with store.commit():
            rows = store.read_set(PENDING, names[0])
            for name in names[1:]:
                rows = rows.unionByName(store.read_set(PENDING, name))
            store.upsert("chunk_embeddings", rows.where("error IS NULL"))
            store.drop_first(PENDING, profile.profile_name)


def run_backfill(store: Store, profile: Profile, provider: Provider, chosen: Selection = Selection(), batch: int = 64, enabled: bool = True, dry_run: bool = False, lot: int = LOT) -> dict[str, int]:
    """Embed what needs it. Counts: candidates and skipped apart, failed per chunk.

    Chunks go to the service in lots, each a commit of its own. A run that was cut
    off leaves the lots that it finished; the next run takes them over before it
    looks for candidates, so no chunk of theirs is sent again.
    """
    if not enabled and not dry_run:
        raise RuntimeError("embeddings are not enabled")
    started, run_id = datetime.now(timezone.utc).replace(tzinfo=None), uuid.uuid4().hex
    seq = clock()
    set_profile(store, profile, seq)
    counts: dict[str, int] = {}
    _log(store, run_id, profile, chosen, "running", started, counts)
    try:
        _fold(store, profile)
        seen = candidates(store.read("periodic_chunks"), store.read("filings"), store.read("periodic_reports"), store.read("company_tickers"), store.read("chunk_embeddings"), profile, chosen)
        tally = {r.needed: r["count"] for r in seen.groupBy("needed").count().collect()}
        todo = seen.where("needed")
        if chosen.limit is not None:
            todo = todo.orderBy("chunk_key").limit(chosen.limit)
        counts = {"candidates": tally.get(True, 0), "skipped": tally.get(False, 0)}
        if not dry_run and counts["candidates"]:
            lots = -(-min(counts["candidates"], chosen.limit or counts["candidates"]) // lot)
            number = F.pmod(F.xxhash64("chunk_key"), F.lit(lots)).cast("int")
            path = scratch_path(store.spark, "backfill")
            todo.withColumn("lot", number).repartition("lot", F.pmod(F.xxhash64("chunk_key", F.lit(1)), F.lit(store.spark.sparkContext.defaultParallelism))).write.partitionBy("lot").parquet(path)
            left = store.spark.read.parquet(path)
            counts |= {"embedded": 0, "failed": 0}
            for i in range(lots):
                done = embed(left.where(F.col("lot") == i), profile, provider, batch)
                rows = done.select("chunk_key", F.lit(profile.profile_name).alias("profile_name"), "content_hash", "embedding_input_hash", "embedding", F.lit(started).alias("embedded_at"), F.lit(seq).cast("long").alias("ingest_seq"), "error")
                kept = store.write_set(PENDING, f"{profile.profile_name}.{run_id}-{i}", rows)  # the provider is asked once
                both = kept.agg(F.count_if(F.col("error").isNull()), F.count_if(F.col("error").isNotNull())).first()
                counts["embedded"] += both[0]
                counts["failed"] += both[1]
            _fold(store, profile)
        _log(store, run_id, profile, chosen, "dry_run" if dry_run else "failed" if counts.get("failed") else "completed", started, counts)
        return counts
    except Exception as problem:
        _log(store, run_id, profile, chosen, "failed", started, counts, f"{type(problem).__name__}: {problem}")
        raise


def enable_vectors(store: Store, profile: Profile) -> Profile:
    """Make the tables, the profile and the index that search by vectors needs (TXT-15); more dimensions than an index takes are refused."""
    if not profile.indexable:
        raise EmbeddingError(f"an index takes {MAX_INDEXED_DIMENSION} dimensions at most, not {profile.embedding_dimension}: choose a smaller dimension for this profile")
    if not store_available(store):
        store.migrate()
    seq = int(datetime.now(timezone.utc).timestamp() * 1e6)
    set_profile(store, profile, seq)
    index_vectors(store, profile)
    return profile


def store_available(store: Store) -> bool:
    """Whether the tables that embeddings need exist (TXT-15)."""
    return all(store.exists(t) for t in ("periodic_chunks", "embedding_profiles", "chunk_embeddings"))
