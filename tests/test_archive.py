"""The archive as a data source, and the backfill that is cut off."""

import json
import time
from pathlib import Path

import pytest

from ledgerloom.operators.embedding import HashEmbedder, Profile, Selection
from ledgerloom.plans.backfill import run_backfill
from ledgerloom.plans.store import Store
from ledgerloom.schemas import ddl
from ledgerloom.sources.archive import ArchiveReader, register

PREFIX = "https://archive.example"


def read(spark, urls, **options):
    register(spark)
    return spark.read.format("archive").options(urls=json.dumps(urls), user_agent="tests", prefix=PREFIX, **{k: str(v) for k, v in options.items()}).load()


def test_reads_a_folder(spark, tmp_path):
    for i in range(12):
        (tmp_path / f"d{i}.txt").write_text(f"text {i}")
    urls = [f"{PREFIX}/d{i}.txt" for i in range(12)]
    begun = time.monotonic()
    df = read(spark, [*urls, f"{PREFIX}/none.txt"], root=tmp_path, per_second=6, tasks=3)
    got = {r.url: (None if r.content is None else bytes(r.content).decode(), r.error) for r in df.collect()}
    assert time.monotonic() - begun >= 2.0  # thirteen documents at six a second
    assert got == {u: (f"text {i}", None) for i, u in enumerate(urls)} | {f"{PREFIX}/none.txt": (None, f"NotFound: {PREFIX}/none.txt")}
    lenient = read(spark, [f"{PREFIX}/none.txt"], root=tmp_path, missing_ok="true").collect()
    assert [(r.content, r.error) for r in lenient] == [(None, None)]
    assert read(spark, [], root=tmp_path).collect() == []


def test_tasks_share_the_rate_and_the_rules(monkeypatch):
    reader = ArchiveReader({"urls": json.dumps([f"u{i}" for i in range(10)]), "user_agent": "a", "per_second": "4", "tasks": "4"})
    shares = reader.partitions()
    assert sorted(u for s in shares for u in s.urls) == sorted(f"u{i}" for i in range(10)) and sum(s.per_second for s in shares) == 4
    with pytest.raises(ValueError):
        ArchiveReader({"urls": '["u"]'})
    answers = {"u0": [(503, b""), (200, b"x")], "u1": [(403, b"")], "u2": [(404, b"")], "u3": [(500, b"")] * 3}

    def fetch(missing_ok):
        left, slept = {k: list(v) for k, v in answers.items()}, []
        reader = ArchiveReader({"urls": json.dumps(list(answers)), "user_agent": "a", "tasks": "1", "per_second": "1000", "missing_ok": missing_ok})
        (share,) = reader.partitions()
        made = reader.fetcher(share)
        made.transport, made.sleep = lambda url, headers, timeout: left[url].pop(0), slept.append
        monkeypatch.setattr(reader, "fetcher", lambda s: made)
        return {u: (c, e and e.split(":")[0]) for u, c, e in reader.read(share)}

    assert fetch("false") == {"u0": (b"x", None), "u1": (None, "FetchError"), "u2": (None, "NotFound"), "u3": (None, "FetchError")}
    assert fetch("true") == {"u0": (b"x", None), "u1": (None, None), "u2": (None, None), "u3": (None, "FetchError")}


class Counting:
    """Writes down every text that it is asked for."""

    def __init__(self, folder, dimension=3):
        self.folder, self.inner = str(folder), HashEmbedder(dimension)

    def __call__(self, texts):
        import uuid

        (Path(self.folder) / uuid.uuid4().hex).write_text(json.dumps(list(texts)))
        return self.inner(texts)

    def asked(self):
        return [t for p in Path(self.folder).iterdir() for t in json.loads(p.read_text())]


def frame(spark, table, rows):
    schema = spark.createDataFrame([], ddl(table)).schema
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema) for r in rows], schema)


def test_a_backfill_that_is_cut_off_asks_for_each_chunk_once(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path / "store"), parts=4)
    store.migrate()
    store.upsert("filings", frame(spark, "filings", [{"accession_number": "a", "cik": "1", "company_name": "C", "form_type": "10-K", "ingest_seq": 1}]))
    store.upsert("periodic_reports", frame(spark, "periodic_reports", [{"accession_number": "a", "ingest_seq": 1}]))
    chunks = [{"chunk_key": f"k{i:03d}", "accession_number": "a", "section_key": "s", "chunk_ordinal": i, "chunk_text": f"words {i}", "content_hash": f"h{i}"} for i in range(60)]
    store.replace("periodic_chunks", frame(spark, "periodic_chunks", chunks[:1]), frame(spark, "periodic_chunks", chunks), "accession_number")
    (tmp_path / "asked").mkdir()
    service, profile = Counting(tmp_path / "asked"), Profile(embedding_dimension=3)
    written, keep = [], Store.write_set

    def cut(self, table, name, df, by=()):
        if len(written) == 3:
            raise KeyboardInterrupt
        written.append(name)
        return keep(self, table, name, df, by)

    monkeypatch.setattr(Store, "write_set", cut)
    with pytest.raises(KeyboardInterrupt):
        run_backfill(store, profile, service, batch=4, lot=10)
    first = len(service.asked())
    assert 0 < first < 60 and store.read("chunk_embeddings").count() == 0
    monkeypatch.setattr(Store, "write_set", keep)
    again = Store(spark, store.root)
    counts = run_backfill(again, profile, service, batch=4, lot=10)
    assert (counts["embedded"], counts["skipped"], counts["failed"]) == (60 - first, first, 0)
    asked = service.asked()
    assert len(asked) == len(set(asked)) == 60
    assert again.read("chunk_embeddings").select("chunk_key").distinct().count() == 60
    assert run_backfill(again, profile, service)["candidates"] == 0 and len(service.asked()) == 60
    assert run_backfill(again, profile, service, Selection(rebuild=True, limit=2))["embedded"] == 2
