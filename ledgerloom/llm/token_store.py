"""Token ids of whole documents in ORC files, in ascending document order.

Layout: quantiles of the ids give ranges, found from the ids alone; there are
never more than MOST_RANGES, so plan and driver stay small whatever the number of
documents. Documents are encoded where they are read (a small table is dealt out first), each gets the number of its range, and only
ids travel, two bytes each where the vocabulary allows it. A range is sorted by
id, and each task writes one file of several stripes, or a few where a range is large. A file's rows hold the document id, the id
count, where the document starts within its range, the range's number and the ids as 32-bit
integers, which ORC stores with run-length encoding. Every stripe carries row
indexes and a Bloom filter on the document id, so a reader prunes stripes by
range or by key, and stripes are read in parallel. The global start of a
document is its range's base, a running sum over one total per range, plus its
start within the range.

Defined cases: a null text counts as empty; every document, empty ones too,
ends with the end id. A null document id sorts first. Rows that repeat an id
are all stored, ordered by a checksum of their ids, and may be in several
files. An empty table gives no rows. Columns other
than the id and the text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import mapped, parts_for, scratch_path, spread
from .tokenizing import encoded, ids_crc32, narrow, wide

STORED = "doc_id bigint, n_tokens bigint, file_start bigint, file_no int, ids array<int>"
#: Ids in one batch that a task hands back, documents of a range on average, ranges at most, and rows of a file at most.
BATCH_IDS, RANGE_DOCS, MOST_RANGES, FILE_ROWS = 1 << 20, 1 << 16, 1 << 14, 1 << 20
#: Bytes of a stripe: several tasks read one file.
STRIPE = 16 << 20
#: Stands for a null id: they sort first.
_NULL = -(2**63)


def _bounds(keys: DataFrame, ranges: int) -> list[int]:
    """Ends of all ranges but the last; an id with more rows than a range ends several of them."""
    if ranges < 2:
        return []
    shares = F.array(*(F.lit(i / ranges) for i in range(1, ranges)))
    return keys.agg(F.percentile_approx("doc_id", shares, max(10_000, 10 * ranges)).alias("b")).first()["b"] or []


def _ranges(ids: np.ndarray, crcs: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The range of each document: by id, and where an id fills several ranges, by checksum among those."""
    low, high = np.searchsorted(bounds, ids, "left"), np.searchsorted(bounds, ids, "right")
    return (low + (((high - low + 1) * crcs) >> 32)).astype(np.int32)


def _dealing_keys(spark: SparkSession, ranges: int) -> list[int]:
    """For each range a number that Spark's hash partitioning deals to the task of that number."""
    place = F.pmod(F.hash(F.col("id").cast("int")), F.lit(ranges))
    found = {r["place"]: r["key"] for r in spark.range(ranges * 40).groupBy(place.alias("place")).agg(F.min("id").cast("int").alias("key")).collect()}
    return [found.get(r, r) for r in range(ranges)]


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", ranges: int | None = None, stripe: int = STRIPE) -> None:
    """Encode `docs` and write the ORC files to `path`. `ranges`: how many; by default they follow the number of documents up to MOST_RANGES."""
    spark = docs.sparkSession
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    keys = slim.select(F.coalesce("doc_id", F.lit(_NULL)).alias("doc_id"))
    ranges = ranges or min(MOST_RANGES, parts_for(keys, RANGE_DOCS))
    bounds, deal = np.array(_bounds(keys, ranges), np.int64), np.array(_dealing_keys(spark, ranges), np.int32)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 512):
                part = batch.slice(at, 512)
                ids = list(encoded(tokenizer_path, part.column(1).cast(pa.binary()).to_pylist(), end_id))
                crcs = np.fromiter(map(ids_crc32, ids), np.int64, len(ids))
                own = _ranges(part.column(0).fill_null(_NULL).to_numpy(), crcs, bounds)
                yield pa.RecordBatch.from_arrays([pa.array(deal[own]), pa.array(own), part.column(0), pa.array(map(len, ids), pa.int32()), pa.array(crcs), pa.array(map(narrow, ids), pa.binary())], names=["deal", "range_no", "doc_id", "n", "crc", "ids"])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        range_no, start = None, 0
        for got in batches:
            own, counts = got.column(0).to_numpy(), np.asarray(got.column(2).to_numpy(), np.int64)
            ends = np.cumsum(counts)
            first = 0
            while first < len(got):
                if own[first] != range_no:
                    range_no, start = own[first], 0
                last = min(int(np.searchsorted(own, range_no, "right")), max(first + 1, int(np.searchsorted(ends, ends[first] - counts[first] + BATCH_IDS, side="right"))))
                offsets = np.concatenate([[0], ends[first:last] - ends[first] + counts[first]])
                ids = np.concatenate([wide(x.as_buffer()) for x in got.column(3)[first:last]])
                lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids.view(np.int32)))
                yield pa.RecordBatch.from_arrays([got.column(1)[first:last], pa.array(counts[first:last]), pa.array(start + offsets[:-1]), pa.array(own[first:last]), lists], names=["doc_id", "n_tokens", "file_start", "file_no", "ids"])
                start += int(offsets[-1])
                first = last

    dealt = spread(slim).transform(mapped, coded, "deal int, range_no int, doc_id bigint, n int, crc bigint, ids binary").repartition(ranges, "deal")
    (
        dealt.sortWithinPartitions("range_no", "doc_id", "crc")
        .select("range_no", "doc_id", "n", "ids")
        .transform(mapped, rows, STORED)
        .write.option("compression", "zstd")
        .option("maxRecordsPerFile", FILE_ROWS)
        .option("orc.stripe.size", stripe)
        .option("orc.rows.between.memory.checks", 256)  # rows are large: look often whether a stripe is full
        .option("orc.create.index", "true")
        .option("orc.row.index.stride", "1000")
        .option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", "0.01")
        .orc(path)
    )


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The stored documents with their global `start`. The driver gets one total per range, MOST_RANGES at most."""
    stored = spark.read.schema(STORED).orc(path)
    bases, total = [], 0
    for row in sorted(stored.groupBy("file_no").agg(F.sum("n_tokens").alias("n")).collect(), key=lambda r: r["file_no"]):
        bases.append((row["file_no"], total))
        total += row["n"]
    files = spark.createDataFrame(bases, "no int, base bigint")
    return stored.join(F.broadcast(files), F.col("file_no") == F.col("no")).select("doc_id", (F.col("base") + F.col("file_start")).alias("start"), "n_tokens", "ids")


def token_digest(tokens: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and the CRC-32 of the ids as little-endian unsigned 32-bit integers."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            flat = np.asarray(lists.values, dtype="<u4")
            at = np.asarray(lists.offsets)
            crcs = [ids_crc32(flat[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(crcs, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return tokens.transform(mapped, digest, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def token_store(docs: DataFrame, tokenizer_path: str, end_id: int = 0, path: str | None = None) -> DataFrame:
    """Write the files, read them back, and return their digest per document."""
    spark = docs.sparkSession
    path = path or scratch_path(spark, "tokens")
    write_tokens(docs, path, tokenizer_path, end_id)
    return token_digest(read_tokens(spark, path))
