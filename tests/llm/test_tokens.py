import struct
import zlib
from collections import defaultdict
from functools import cache

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ledgerloom.llm.packing import first_fit_decreasing, pack, packed
from ledgerloom.llm.common import scratch_path
from ledgerloom.llm.token_store import read_tokens, token_digest, token_store, write_tokens
from ledgerloom.llm.tokenizing import TextEncoder

FILES = ("word_bpe_49k.json", "byte_bpe_50k.json")


@pytest.fixture(scope="module", params=FILES)
def pair(request):
    path = public_tokenizers.path(request.param)
    plain = Tokenizer.from_file(path)
    plain.encode_special_tokens = True
    return TextEncoder(path), plain


@cache
def library(path):
    plain = Tokenizer.from_file(path)
    plain.encode_special_tokens = True
    return plain


def plain_ids(path, text, end):
    plain = library(path)
    ids = [*plain.encode(text or "", add_special_tokens=False).ids, end]
    return ids


def crc(ids):
    return zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text(" \n\t,.'!aAsSéßÀ×Σ1́  \x1c\x00中<|", max_size=30), max_size=6))
def test_encoder_equals_library(pair, texts):
    encoder, plain = pair
    ids, counts = encoder.encode_many([t.encode() for t in texts])
    assert [plain.encode(t, add_special_tokens=False).ids for t in texts] == [ids[sum(counts[:i]) : sum(counts[: i + 1])].tolist() for i in range(len(texts))]


def test_encoder_on_documents(pair, texts):
    encoder, plain = pair
    for text in list(texts.values())[:60]:
        assert encoder.encode(text) == plain.encode(text, add_special_tokens=False).ids


def check_store(got, docs):
    path, start = public_tokenizers.path("byte_bpe_50k.json"), 0
    want = []
    coded = [(key, plain_ids(path, text, 0)) for key, text in docs]
    for key, ids in sorted(coded, key=lambda d: (d[0] is not None, d[0] or 0, crc(d[1]))):
        want.append((key, start, len(ids), crc(ids)))
        start += len(ids)
    assert sorted(map(tuple, got.collect()), key=lambda r: r[1]) == want


def test_store(spark, sf_dir, texts, hard, empty):
    path = public_tokenizers.path("byte_bpe_50k.json")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    check_store(token_store(docs, path), texts.items())
    check_store(token_store(hard, path), [(r.doc_id, r.text) for r in hard.collect()])
    assert token_store(empty, path).collect() == []


def test_store_prunes_and_keeps_ids(spark, sf_dir, texts, tmp_path):
    path, out = public_tokenizers.path("byte_bpe_50k.json"), f"file://{tmp_path}/tokens"
    write_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"), out, path, ranges=3)
    stored = read_tokens(spark, out)
    assert stored.where("doc_id = 7").first().ids == plain_ids(path, texts[7], 0)
    import pyarrow.orc as orc

    files = sorted(tmp_path.glob("tokens/*.orc"))
    assert len(files) == 3
    reader = spark._jvm.org.apache.orc.OrcFile.createReader(spark._jvm.org.apache.hadoop.fs.Path(f"file://{files[0]}"), spark._jvm.org.apache.orc.OrcFile.readerOptions(spark._jsc.hadoopConfiguration()))
    footer = reader.rows().readStripeFooter(reader.getStripes().get(0))
    kinds = {footer.getStreams(i).getKind().toString() for i in range(footer.getStreamsCount())}
    assert {"ROW_INDEX", "BLOOM_FILTER_UTF8"} <= kinds
    assert "EqualTo(doc_id,7)" in stored.where("doc_id = 7")._jdf.queryExecution().toString()
    ranges = [(min(t), max(t)) for t in (orc.ORCFile(f).read(["doc_id"])["doc_id"].to_pylist() for f in files)]
    assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:], strict=False))


def test_stripes_of_a_file_are_read_in_parallel(spark, sf_dir, texts, tmp_path, monkeypatch):
    """Several stripes a file, several files a range: tasks read stretches of a file, and the documents are the same."""
    from ledgerloom.llm import token_store as T

    path, out = public_tokenizers.path("byte_bpe_50k.json"), f"file://{tmp_path}/tokens"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    copies = range(0, 600_000, 100_000)
    more = docs.selectExpr("explode(sequence(0L, 500000L, 100000L)) AS k", "*").selectExpr("doc_id + k AS doc_id", "text")
    write_tokens(more, out, path, ranges=1, stripe=1 << 16)
    import pyarrow.orc as orc

    (file,) = tmp_path.glob("tokens/*.orc")
    stripes = orc.ORCFile(file).nstripes
    assert stripes >= 3
    spark.conf.set("spark.sql.files.maxPartitionBytes", file.stat().st_size // 3)
    spark.conf.set("spark.sql.files.openCostInBytes", 0)
    try:
        got = token_digest(read_tokens(spark, out))
        tasks = {r.p for r in spark.read.orc(out).selectExpr("spark_partition_id() AS p").collect()}
        assert len(tasks) >= 2
        check_store(got, [(i + k, t) for k in copies for i, t in texts.items()])
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    monkeypatch.setattr(T, "FILE_ROWS", 70)
    write_tokens(docs, f"{out}-small", path, ranges=2)
    assert len(list(tmp_path.glob("tokens-small/*.orc"))) > 2
    check_store(token_digest(read_tokens(spark, f"{out}-small")), texts.items())


def test_ranges_are_bounded(spark, texts, monkeypatch):
    from ledgerloom.llm import token_store as T

    monkeypatch.setattr(T, "MOST_RANGES", 3)
    monkeypatch.setattr(T, "RANGE_DOCS", 5)
    out = scratch_path(spark, "bounded")
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    write_tokens(docs, out, public_tokenizers.path("byte_bpe_50k.json"))
    assert {r.file_no for r in spark.read.orc(out).select("file_no").distinct().collect()} == {0, 1, 2}
    check_store(token_digest(read_tokens(spark, out)), texts.items())


def test_an_id_may_fill_several_ranges(spark):
    """Rows of one id, and of none, are dealt to several tasks and still stored in order of id and checksum."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    docs = [(5, f"row {i}") for i in range(60)] + [(None, f"none {i}") for i in range(20)] + [(i, f"text {i}") for i in range(10)]
    for ranges in (1, 4, 9):
        out = f"{scratch_path(spark, 'several')}"
        write_tokens(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3), out, path, ranges=ranges)
        stored = read_tokens(spark, out)
        check_store(token_digest(stored), docs)
        assert stored.select("doc_id").where("doc_id = 5").count() == 61
        assert len({r.file_no for r in spark.read.orc(out).where("doc_id = 5").collect()}) >= min(ranges, 2)


def check_pieces(got, docs, capacity=2048, path=None):
    path = path or public_tokenizers.path("word_bpe_49k.json")
    want = sorted((key is not None, key or 0, plain_ids(path, text, 1)) for key, text in docs)
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in got:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert sum(r.length for r in got) == sum(len(w[2]) for w in want)
    for known, key, ids in want:
        mine = [r for r in by_doc[key if known else None] if r.doc_tokens == len(ids)]
        assert all(crc(ids[r.start : r.start + r.length]) == r.ids_crc32 or len(by_doc[key if known else None]) > 1 for r in mine)
        assert {i for r in mine for i in range(r.start, r.start + r.length)} == set(range(len(ids)))
    for pieces in by_sequence.values():
        pieces.sort(key=lambda r: r.offset)
        at = 0
        for p in pieces:
            assert p.offset == at
            at += p.length
        assert 0 < at <= capacity
    return len(by_sequence)


def test_packing(spark, sf_dir, texts, hard, empty):
    path = public_tokenizers.path("word_bpe_49k.json")
    got = pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), path, group_docs=64).collect()
    assert len({(r.doc_id, r.start) for r in got}) == len(got)
    sequences = check_pieces(got, texts.items())
    assert sum(r.length for r in got) > 0.97 * 2048 * (sequences - 4)
    check_pieces(pack(hard, path, group_docs=4).collect(), [(r.doc_id, r.text) for r in hard.collect()])
    assert pack(empty, path).collect() == []


def test_first_fit_decreasing_is_first_fit():
    import random

    rnd = random.Random(3)
    for _ in range(200):
        lengths = [rnd.randint(1, 50) for _ in range(rnd.randint(0, 40))]
        room, want = [], []
        for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
            at = next((b for b, r in enumerate(room) if r >= lengths[i]), None)
            if at is None:
                at = len(room)
                room.append(50)
                want.append([])
            room[at] -= lengths[i]
            want[at].append(i)
        assert first_fit_decreasing(lengths, 50) == want


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 60), max_size=40))
def test_packed_is_whole(lengths):
    sequences = packed(lengths, 16)
    seen = sorted((doc, i) for s in sequences for doc, start, n in s for i in range(start, start + n))
    assert seen == [(d, i) for d, n in enumerate(lengths) for i in range(n)]
    assert all(sum(p[2] for p in s) <= 16 for s in sequences)
    assert len(sequences) == -(-sum(lengths) // 16)
