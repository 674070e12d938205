"""Acquisition as Spark jobs: mirrors, tasks that share a rate, and what was cached last."""

from datetime import date

from ledgerloom import filing_queries
from ledgerloom.cli import parser
from ledgerloom.plans import ingest
from ledgerloom.plans.acquire import acquire, fetching, mirror
from ledgerloom.plans.fetch import Fetcher, folder_transport
from ledgerloom.sources import artifacts

from .test_plans import ARCHIVE, put
from .test_sources import HTML, document

ENTRY = "accession_number string, form_type string, filed_date date, archive_path string, index_url string, submission_url string, filing_directory_url string"


def entry(key, form, submission=True):
    place = f"{ARCHIVE}/edgar/data/7/{key}"
    return (key, form, date(2024, 5, 16), f"edgar/data/7/{key}.txt", f"{place}/index.json", f"{place}.txt" if submission else None, place)


def test_mirror(spark):
    """Repeated addresses, missing documents, envelopes without documents, entries without an address."""
    place = f"{ARCHIVE}/edgar/data/7"
    site = spark.createDataFrame([(f"{place}/a.txt", document("13F-NT", 1, "c.xml").encode()), (f"{place}/a/c.xml", b"old"), (f"{place}/a/c.xml", b"the new"), (f"{place}/b.txt", document("13F-HR", 1, "c.xml").encode()), (f"{place}/c.txt", b""), (None, b"x"), (f"{place}/a/index.json", None)], "url string, content binary")
    entries = spark.createDataFrame([entry("a", "13F-NT"), entry("b", "13F-HR"), entry("c", "13F-HR"), entry("d", "13F-HR"), entry("e", "13F-HR", False)], ENTRY)
    kept, failures = acquire(entries, True, mirror(site), ingest.scratch_path(spark, "mirror"))
    assert {(r.accession_number, r.role, r.filename, bytes(r.content)) for r in kept.where("accession_number = 'a'").collect()} == {("a", "submission_text", "a.txt", document("13F-NT", 1, "c.xml").encode()), ("a", "primary_xml", "c.xml", b"the new")}
    assert dict(map(tuple, failures.collect())) == {"b": "ValueError: no information table", "c": "ValueError: no XML documents", "d": f"NotFound: {place}/d.txt", "e": "NotFound: no address"}
    none, nothing = acquire(entries.limit(0), False, mirror(site.limit(0)), ingest.scratch_path(spark, "mirror"))
    assert none.count() == nothing.count() == 0


def test_tasks_share_the_rate(spark, tmp_path):
    put(tmp_path, "edgar/data/7/r.txt", document("10-K", 1, "annual.htm") + document("EX-101.INS", 2, "data.xml") + document("EX-101.SCH", 3, "data.xsd"))
    put(tmp_path, "edgar/data/7/r/annual.htm", HTML)
    put(tmp_path, "edgar/data/7/r/data.xsd", "<x/>")
    root = str(tmp_path)

    def fetcher(rate):
        if rate != 1.25:
            raise ValueError(rate)

        def transport(url, headers, timeout):
            return (500, b"") if url.endswith("broken.txt") else folder_transport(root, ARCHIVE)(url, headers, timeout)

        return Fetcher("tests", transport, per_second=1e6, sleep=lambda s: None)

    entries = spark.createDataFrame([entry("r", "10-K"), entry("broken", "10-K")], ENTRY)
    kept, failures = acquire(entries, False, fetching(fetcher, 5.0, 4), ingest.scratch_path(spark, "tasks"))
    assert {(r.role, r.filename) for r in kept.collect()} == {("submission_text", "r.txt"), ("primary_document", "annual.htm"), ("xbrl_artifact_2", "data.xsd")}
    assert dict(map(tuple, failures.collect())) == {"broken": f"FetchError: {ARCHIVE}/edgar/data/7/broken.txt: status 500"}


def test_what_was_cached_last_counts(spark, tmp_path):
    """A document cached in a batch, again in a later one, and in a file of its own in between."""
    root = str(tmp_path)
    artifacts.save_artifact(root, "a", "primary_xml", "u", "one.xml", b"file")
    seq = artifacts.read_artifacts(spark, root).first().cached_seq
    for batch, body in ((seq - 1, b"before"), (seq + 1, b"after")):
        rows = spark.createDataFrame([("a", "primary_xml", "u", "one.xml", body), ("b", "primary_xml", "u", "two.xml", None)], "accession_number string, role string, url string, filename string, content binary")
        rows.write.parquet(f"{artifacts.batch_folder(root, batch)}/step=filings")
    for some in (None, ["a"]):
        got = sorted((r.cached_seq - seq, bytes(r.content)) for r in artifacts.read_artifacts(spark, root, some).collect())
        assert got == [(-1, b"before"), (0, b"file"), (1, b"after")]
    assert artifacts.read_artifacts(spark, root, ["b"]).count() == 0


def test_command_line():
    got = parser().parse_args(["ingest", "13f", "--mode", "full", "--mirror", "m.parquet"])
    assert (got.mirror, got.tasks) == ("m.parquet", 1)


def test_a_site_is_built_once(spark, sf_dir):
    """Whatever a run asks of the mirror reads written tables; no table of holdings is put together anew."""
    first, second = filing_queries._site(spark, sf_dir, "", " II")
    for site in (first, second):
        assert "Window" not in site._jdf.queryExecution().optimizedPlan().toString()
    other = first.exceptAll(second)
    assert 0 < other.count() < first.count() and other.where("url NOT LIKE '%/full-index/%'").isEmpty()
