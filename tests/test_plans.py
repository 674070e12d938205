"""Ingestion end to end from a folder, storage, refresh, backfill and the incremental stream."""

import hashlib
from datetime import date

import pytest
from pyspark.sql import functions as F

from ledgerloom.cli import parser
from ledgerloom.operators import quality
from ledgerloom.operators.embedding import EmbeddingError, HashEmbedder, Profile, Selection, ServiceEmbedder, response_vectors
from ledgerloom.operators.search import cosine_top, match_all, postings, search_index
from ledgerloom.operators.upsert import artifact_fingerprint, processing_state
from ledgerloom.plans import ingest
from ledgerloom.plans.backfill import enable_vectors, run_backfill
from ledgerloom.plans.fetch import Fetcher, folder_transport
from ledgerloom.plans.refresh import register_top_positions, register_views
from ledgerloom.plans.store import Store
from ledgerloom.schemas import KEYS, REFERENCES
from ledgerloom.streaming.incremental import index_stream, run_available, upserting

from .test_holdings import COVER, ROWS
from .test_sources import HTML, document

ARCHIVE = "https://archive.example/Archives"
ACCESSION = "0000950123-24-005622"
TODAY = date(2024, 5, 17)


def put(root, path, text):
    target = root / path
    target.parent.mkdir(parents=True, exist_ok=True)
    target.write_text(text)


@pytest.fixture(scope="module")
def world(spark, tmp_path_factory):
    """An archive with one good and one broken holdings filing and one annual report, and an empty store."""
    root = tmp_path_factory.mktemp("world")
    site = root / "site"
    entries = [
        f"1067983|BIG CO|13F-HR|2024-05-15|edgar/data/1067983/{ACCESSION}.txt",
        "99|BROKEN|13F-HR|2024-05-16|edgar/data/99/0000000099-24-000001.txt",
        "7|SMALL|10-K|2024-05-16|edgar/data/7/0000000007-24-000001.txt",
    ]
    put(site, "edgar/daily-index/2024/QTR2/master.20240516.idx", "top\n----\n" + "\n".join(entries) + "\n")
    put(site, f"edgar/data/1067983/{ACCESSION}.txt", "<ACCEPTANCE-DATETIME>20240515123045\n" + document("13F-HR", 1, "primary_doc.xml") + document("INFORMATION TABLE", 2, "infotable.xml"))
    folder = f"edgar/data/1067983/{ACCESSION.replace('-', '')}"
    put(site, f"{folder}/primary_doc.xml", COVER.format(form="13F-HR", flag="false", kind=""))
    put(site, f"{folder}/infotable.xml", ROWS)
    put(site, f"{folder}/index.json", "{}")
    put(site, "edgar/data/99/0000000099-24-000001.txt", document("13F-HR", 1, "note.htm"))
    put(site, "edgar/data/7/0000000007-24-000001.txt", document("10-K", 1, "annual.htm") + document("EX-101.INS", 2, "data.xml"))
    put(site, "edgar/data/7/000000000724000001/annual.htm", HTML)
    store = Store(spark, str(root / "store"))
    assert set(store.migrate()) == set(KEYS)
    assert store.migrate() == []
    fetcher = Fetcher("tests", folder_transport(str(site), ARCHIVE), per_second=1e6, sleep=lambda s: None)
    return store, fetcher, str(root / "cache")


def test_ingest_and_refresh(spark, world):
    store, fetcher, cache = world
    options = ingest.Options(ingest.HOLDINGS, "daily", start=date(2024, 5, 13))
    assert ingest.run_ingest(spark, store, fetcher, cache, options, TODAY, ARCHIVE) == 1  # one filing fails, the other is stored
    run = store.read("ingestion_runs").first()
    assert (run.status, '"processed": 1' in run.stats_json, '"failed": 1' in run.stats_json) == ("PARTIAL_SUCCESS", True, True)
    states = {r.accession_number: (r.status, r.error) for r in store.read("filing_processing").collect()}
    assert states[ACCESSION] == ("SUCCESS", None) and states["0000000099-24-000001"][0] == "FAILED"
    assert store.read("thirteenf_holdings").count() == 2
    assert str(store.read("filings").first().acceptance_datetime) == "2024-05-15 12:30:45"
    positions = store.read("filer_positions").collect()
    assert {(p.issuer_name, p.put_call_key, int(p.total_value_usd)) for p in positions} == {("APPLE INC", "NONE", 150), ("NVIDIA CORP", "PUT", 50)}
    assert ingest.load_checkpoint(store, ingest.HOLDINGS, "daily").accession_number == ACCESSION
    register_views(store)
    register_top_positions(spark)
    assert [r.issuer_name for r in spark.sql("SELECT * FROM top_positions('1067983', DATE '2024-03-31', 1)").collect()] == ["APPLE INC"]
    before = {t: sorted(map(str, store.read(t).drop("ingest_seq", "started_at", "finished_at").collect())) for t in ("filings", "filers", "thirteenf_holdings", "security_references", "filer_positions")}
    stats = ingest.run_reprocess(spark, store, cache, ingest.HOLDINGS)
    assert (stats.processed, stats.failed) == (1, 0)
    assert before == {t: sorted(map(str, store.read(t).drop("ingest_seq", "started_at", "finished_at").collect())) for t in before}
    for child, columns, parent, key in REFERENCES:
        assert quality.orphans(store.read(child), columns, store.read(parent), key).count() == 0
    for table, key in KEYS.items():
        assert quality.duplicate_keys(store.read(table), key).count() == 0


def test_periodic_and_backfill(spark, world):
    store, fetcher, cache = world
    options = ingest.Options(ingest.PERIODIC, "dev", start=date(2024, 5, 13))
    assert ingest.run_ingest(spark, store, fetcher, cache, options, TODAY, ARCHIVE) == 0
    report = store.read("periodic_reports").first()
    assert (report.report_period, report.section_count, report.fiscal_year) == (date(2024, 12, 31), 2, 2024)
    chunks = store.read("periodic_chunks").collect()
    assert {c.section_key for c in chunks} == {"risk_factors", "mda"}
    profile = Profile(embedding_dimension=8)
    with pytest.raises(RuntimeError):
        run_backfill(store, profile, HashEmbedder(8), enabled=False)
    assert run_backfill(store, profile, HashEmbedder(8), enabled=False, dry_run=True)["candidates"] == len(chunks)
    assert run_backfill(store, profile, HashEmbedder(8), batch=1)["embedded"] == len(chunks)
    again = run_backfill(store, profile, HashEmbedder(8))
    assert (again["candidates"], again["skipped"]) == (0, len(chunks))
    assert run_backfill(store, profile, HashEmbedder(8), Selection(rebuild=True, limit=1))["embedded"] == 1
    assert run_backfill(store, profile, HashEmbedder(8), Selection(cik="0000000007", form_type="10-K"))["skipped"] == len(chunks)
    assert run_backfill(store, profile, HashEmbedder(8), Selection(ticker="none"))["skipped"] == 0
    assert run_backfill(store, profile, HashEmbedder(5), Selection(rebuild=True))["failed"] == len(chunks)
    # Other settings discard the profile's embeddings.
    assert run_backfill(store, Profile(embedding_dimension=4), HashEmbedder(4))["embedded"] == len(chunks)
    assert {len(r.embedding) for r in store.read("chunk_embeddings").collect()} == {4}


def test_stream(spark, tmp_path):
    put(tmp_path, "in/a.idx", f"----\n1|A|13F-HR|2024-05-15|edgar/data/1/{ACCESSION}.txt\n")
    store = Store(spark, str(tmp_path / "store"))
    store.migrate()

    def apply(batch, number):
        extra = [c for c in store.read("filings").columns if c not in batch.columns]
        upserting(store, "filings", ["accession_number"])(batch.dropDuplicates(["accession_number"]).withColumns({c: F.lit(None).cast(dict(store.read("filings").dtypes)[c]) for c in extra}), number)

    for content, want in ((None, ["A"]), (f"----\n1|B|13F-HR|2024-05-15|edgar/data/1/{ACCESSION}.txt\n2|C|13F-HR|2024-05-16|edgar/data/2/0000000002-24-000001.txt\n", ["B", "C"])):
        if content:
            put(tmp_path, "in/b.idx", content)
        run_available(index_stream(spark, str(tmp_path / "in"), ARCHIVE), apply, str(tmp_path / "progress"))
        assert sorted(r.company_name for r in store.read("filings").collect()) == want


def test_fingerprint_and_state(spark):
    rows = [("a", "x", "f", "1"), ("a", "y", "g", "2")]
    prints = [artifact_fingerprint(spark.createDataFrame(r, "accession_number string, role string, filename string, sha256 string")).first().artifact_fingerprint for r in (rows, rows[::-1])]
    assert prints == [hashlib.sha256(b"x:1\ny:2\n").hexdigest()] * 2
    log = spark.createDataFrame([("a", "RUNNING", None, 1, 1), ("a", "FAILED", "no", 2, 2), ("a", "RUNNING", None, 3, 3)], "k string, status string, error string, at int, ingest_seq int")
    assert tuple(processing_state(log, ["k"]).first()) == ("a", "RUNNING", None, 3, None)


def test_search(spark):
    docs = spark.createDataFrame([(1, "The cat sat"), (2, "cat cat dog"), (3, "dog"), (4, None)], "id int, text string")
    assert {(r.id, r.hits) for r in match_all(docs, "id", "text", ["Cat"]).collect()} == {(1, 1), (2, 2)}
    ranked = search_index(postings(docs, "id", "text"), ["cat"], 4).collect()
    assert [r.id for r in ranked] == [2, 1]
    vectors = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, [1.0, 1.0]), (4, None), (5, [1.0])], "id int, v array<float>")
    assert [(r.id, round(r.similarity, 4)) for r in cosine_top(vectors, "id", "v", [1.0, 0.0], 5).collect()] == [(1, 1.0), (3, 0.7071)]


def test_embedding_service():
    body = {"data": [{"index": 1, "embedding": [0, 0, 1]}, {"index": 0, "embedding": [1, 0, 0]}]}
    assert response_vectors(body, 2, 3) == [[1.0, 0.0, 0.0], [0.0, 0.0, 1.0]]
    for count, dimension in ((3, 3), (2, 4)):
        with pytest.raises(EmbeddingError):
            response_vectors(body, count, dimension)
    answers, slept = [(429, {}), (500, {}), (200, body)], []
    service = ServiceEmbedder("u", "k", "m", 3, lambda *a: answers.pop(0), sleep=slept.append)
    assert len(service(["a", "b"])) == 2 and slept == [1.0, 2.0]
    with pytest.raises(ValueError):
        Profile("Bad Name")


def test_command_line():
    got = parser().parse_args(["ingest", "periodic", "--mode", "full", "--form-type", "10-K", "--exclude-amendments", "--from-date", "2024-01-02"])
    assert (got.family, got.mode, got.form_type, got.exclude_amendments, got.from_date) == ("periodic", "full", "10-K", True, date(2024, 1, 2))
    assert parser().parse_args(["reprocess", "13f", "--accession", "x"]).accession == "x"
    assert parser().parse_args(["embeddings", "backfill", "periodic", "--rebuild", "--limit", "5"]).limit == 5
    assert parser().parse_args(["db", "enable-vector"]).profile == "default"
    assert parser().parse_args(["reprocess", "13f", "--skip-analytics-refresh"]).skip_analytics_refresh
    assert parser().parse_args(["embeddings", "backfill", "periodic", "--filed-from", "2024-01-02"]).from_date == date(2024, 1, 2)
    with pytest.raises(SystemExit):
        parser().parse_args(["ingest", "13f"])


def test_embedder_by_settings():
    from ledgerloom.config import Settings
    from ledgerloom.operators.embedding import embedder

    profile = Profile(model="m", embedding_dimension=2)
    assert isinstance(embedder(Settings(), profile), HashEmbedder)
    asked = []
    service = embedder(Settings(embedding_url="u", embedding_key="k"), profile, lambda *a: asked.append(a) or (200, {"data": [{"index": 0, "embedding": [1, 2]}]}))
    assert service(["x"]) == [[1.0, 2.0]] and asked[0][0] == "u" and asked[0][2] == {"model": "m", "input": ["x"]}


def test_enable_vectors(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    with pytest.raises(EmbeddingError):
        enable_vectors(store, Profile(embedding_dimension=2001))
    enable_vectors(store, Profile(model="m", embedding_dimension=2000))
    assert [(r.profile_name, r.embedding_dimension) for r in store.read("embedding_profiles").collect()] == [("default", 2000)]


def test_places_of_filings(spark):
    """By date and accession number, without one task for all of them."""
    rows = [("b", date(2024, 1, 2)), ("a", date(2024, 1, 2)), ("c", date(2024, 1, 1)), ("z", None), ("d", date(2024, 1, 3))]
    got = {r.accession_number: r.place for r in ingest.numbered(spark.createDataFrame(rows, "accession_number string, filed_date date")).collect()}
    assert got == {"z": 1, "c": 2, "a": 3, "b": 4, "d": 5}
