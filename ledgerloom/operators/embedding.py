"""Embedding profiles, candidates and backfill as set operations (TXT-11 to TXT-15, SNK-13 to SNK-15)."""

from __future__ import annotations

import hashlib
import math
import re
import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from datetime import date

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.normalise import TEMPLATE_VERSION, embedding_input, embedding_input_hash, tidy_cik

#: Vectors of more dimensions are stored but not indexed.
MAX_INDEXED_DIMENSION = 2000
RETRIED = frozenset((429, 500, 502, 503, 504))
#: Texts to vectors, in order. Runs on executors, so it has to be picklable.
Provider = Callable[[Sequence[str]], Sequence[Sequence[float]]]


class EmbeddingError(RuntimeError):
    pass


@dataclass(frozen=True)
class Profile:
    profile_name: str = "default"
    provider: str = "openai-compatible"
    model: str = ""
    embedding_dimension: int = 1536
    distance_metric: str = "cosine"
    template_version: str = TEMPLATE_VERSION

    def __post_init__(self) -> None:
        if not re.fullmatch(r"[a-z0-9][a-z0-9_-]{0,62}", self.profile_name):
            raise ValueError(f"bad profile name {self.profile_name!r}")
        if self.embedding_dimension <= 0:
            raise ValueError("embedding_dimension has to be positive")

    @property
    def indexable(self) -> bool:
        return self.embedding_dimension <= MAX_INDEXED_DIMENSION


@dataclass(frozen=True)
class Selection:
    """Which chunks a backfill looks at (FLT-05)."""

    cik: str | None = None
    ticker: str | None = None
    form_type: str = "all"
    filed_from: date | None = None
    filed_to: date | None = None
    rebuild: bool = False
    limit: int | None = None
    after_key: str | None = None

    def forms(self) -> tuple[str, str] | None:
        form = self.form_type.strip().upper()
        return None if form == "ALL" else (form, f"{form}/A")


class HashEmbedder:
    """Deterministic vectors from hashed words, for runs without a service."""

    def __init__(self, dimension: int):
        self.dimension = dimension

    def __call__(self, texts: Sequence[str]) -> list[list[float]]:
        return [self._one(t) for t in texts]

    def _one(self, text: str) -> list[float]:
        vector = [0.0] * self.dimension
        for word in text.lower().split():
            at = int.from_bytes(hashlib.blake2b(word.encode(), digest_size=8).digest(), "little")
            vector[at % self.dimension] += 1.0 if at >> 63 else -1.0
        size = math.sqrt(sum(x * x for x in vector)) or 1.0
        return [x / size for x in vector]


class ServiceEmbedder:
    """Posts batches to an embeddings endpoint; `post(url, headers, payload, timeout)` gives (status, parsed JSON)."""

    def __init__(self, url: str, key: str, model: str, dimension: int, post: Callable, attempts: int = 3, timeout: float = 60.0, sleep: Callable[[float], None] = time.sleep):
        self.url, self.key, self.model, self.dimension = url, key, model, dimension
        self.post, self.attempts, self.timeout, self.sleep = post, attempts, timeout, sleep

    def __call__(self, texts: Sequence[str]) -> list[list[float]]:
        payload = {"model": self.model, "input": list(texts)}
        for attempt in range(1, self.attempts + 1):
            status, body = self.post(self.url, {"Authorization": f"Bearer {self.key}", "Content-Type": "application/json"}, payload, self.timeout)
            if status == 200:
                return response_vectors(body, len(texts), self.dimension)
            if status not in RETRIED or attempt == self.attempts:
                raise EmbeddingError(f"embedding service answered {status}")
            self.sleep(min(8.0, 2.0 ** (attempt - 1)))
        raise EmbeddingError("no attempts allowed")


def post_json(url: str, headers: dict[str, str], payload: dict, timeout: float) -> tuple[int, dict]:
    """Status and parsed body; a connection that fails counts as a service that is away."""
    import json
    from urllib.error import HTTPError, URLError
    from urllib.request import Request, urlopen

    try:
        with urlopen(Request(url, json.dumps(payload).encode(), headers), timeout=timeout) as answer:
            return answer.status, json.loads(answer.read())
    except HTTPError as error:
        return error.code, {}
    except (URLError, TimeoutError):
        return 503, {}


def embedder(settings, profile: Profile, post: Callable = post_json) -> Provider:
    """The service that settings name, else hashed words."""
    if not settings.embedding_url:
        return HashEmbedder(profile.embedding_dimension)
    return ServiceEmbedder(settings.embedding_url, settings.embedding_key, profile.model, profile.embedding_dimension, post, timeout=settings.embedding_timeout)


def response_vectors(body: dict, count: int, dimension: int) -> list[list[float]]:
    """Vectors in order of their index; their number and dimension have to be right (TXT-12)."""
    data = sorted(body.get("data") or [], key=lambda d: int(d.get("index", 0)))
    if len(data) != count:
        raise EmbeddingError(f"{len(data)} vectors for {count} texts")
    vectors = [[float(x) for x in d["embedding"]] for d in data]
    wrong = next((len(v) for v in vectors if len(v) != dimension), None)
    if wrong is not None:
        raise EmbeddingError(f"a vector has {wrong} dimensions instead of {dimension}")
    return vectors


def upsert_profile(current: DataFrame, profile: Profile, seq: int) -> tuple[DataFrame, bool]:
    """Profiles after `profile` is set, and whether its settings changed, which makes its embeddings worthless (SNK-15)."""
    fields = ["profile_name", "provider", "model", "embedding_dimension", "distance_metric", "template_version"]
    values = [getattr(profile, f) for f in fields]
    known = current.where(F.col("profile_name") == profile.profile_name).select(*fields).first()  # the key: one row
    if known is not None and list(known) == values:
        return current, False
    row = current.sparkSession.createDataFrame([(*values, seq)], current.schema)
    return current.where(F.col("profile_name") != profile.profile_name).unionByName(row), known is not None


def candidates(chunks: DataFrame, filings: DataFrame, reports: DataFrame, tickers: DataFrame, embeddings: DataFrame, profile: Profile, chosen: Selection = Selection()) -> DataFrame:
    """Selected chunks with their embedding input, its hash, and whether they need embedding (TXT-13, FLT-13)."""
    symbols = tickers.groupBy("cik").agg(F.min("ticker").alias("ticker"))
    filed = filings.select("accession_number", "cik", "company_name", "form_type", "filed_date", "period_of_report")
    if chosen.cik:
        filed = filed.where(F.col("cik") == tidy_cik(F.lit(chosen.cik)))
    if chosen.ticker:
        filed = filed.join(tickers.where(F.upper("ticker") == chosen.ticker.strip().upper()).select("cik"), "cik", "left_semi")
    if chosen.forms():
        filed = filed.where(F.col("form_type").isin(*chosen.forms()))
    if chosen.filed_from:
        filed = filed.where(F.col("filed_date") >= F.lit(chosen.filed_from))
    if chosen.filed_to:
        filed = filed.where(F.col("filed_date") <= F.lit(chosen.filed_to))
    rows = chunks.where(F.col("chunk_key") > F.lit(chosen.after_key)) if chosen.after_key else chunks
    mine = embeddings.where(F.col("profile_name") == profile.profile_name).select("chunk_key", F.col("content_hash").alias("_content"), F.col("embedding_input_hash").alias("_input"))
    joined = (
        rows.join(filed, "accession_number")
        .join(reports.select("accession_number", F.col("report_period").alias("_period")), "accession_number")
        .join(symbols, "cik", "left")
        .join(mine, "chunk_key", "left")
        .withColumn("report_period", F.coalesce("_period", "period_of_report"))
    )
    parts = ["company_name", "cik", "ticker", "form_type", "filed_date", "report_period", "accession_number", "section_key", "section_title", "item_label", "chunk_ordinal", "chunk_text"]
    text = joined.withColumn("embedding_input", embedding_input(*map(F.col, parts))).withColumn("embedding_input_hash", embedding_input_hash(F.col("embedding_input")))
    same = F.col("content_hash").eqNullSafe(F.col("_content")) & F.col("embedding_input_hash").eqNullSafe(F.col("_input"))
    return text.withColumn("needed", F.lit(chosen.rebuild) | ~same).select("chunk_key", "content_hash", "embedding_input", "embedding_input_hash", "needed")


def embed(rows: DataFrame, profile: Profile, provider: Provider, batch: int = 64) -> DataFrame:
    """`rows` (chunk_key, content_hash, embedding_input, embedding_input_hash) with their vectors, or the error of their batch."""
    names = ["chunk_key", "content_hash", "embedding_input_hash"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for got in batches:
            for at in range(0, len(got), batch):
                part = got.slice(at, batch)
                try:
                    vectors, error = [list(v) for v in provider(part.column(3).to_pylist())], None
                    if any(len(v) != profile.embedding_dimension for v in vectors) or len(vectors) != len(part):
                        raise EmbeddingError("wrong number or dimension of vectors")
                except Exception as problem:
                    vectors, error = [None] * len(part), f"{type(problem).__name__}: {problem}"
                yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array(vectors, pa.list_(pa.float32())), pa.array([error] * len(part), pa.string())], names=[*names, "embedding", "error"])

    return rows.select(*names, "embedding_input").mapInArrow(run, "chunk_key string, content_hash string, embedding_input_hash string, embedding array<float>, error string")
