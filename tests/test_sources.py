"""Indexes, envelopes, reports, calendars, configuration and fetching."""

from datetime import date
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerloom.config import ConfigError, load_settings
from ledgerloom.functions import normalise as N
from ledgerloom.operators.chunks import spans, split_text
from ledgerloom.plans.fetch import Fetcher, FetchError, NotFound
from ledgerloom.sources import calendar as C
from ledgerloom.sources import reports as R
from ledgerloom.sources.index import beyond_checkpoint, decoded, index_entries, periodic_forms, wanted
from ledgerloom.sources.submission import documents, header, holdings_documents, periodic_documents

INDEX = "Description: index\nCloud: x|y\n\n-----------------\n1067983|BIG CO|13F-HR|2024-05-15|edgar/data/1067983/0000950123-24-005622.txt\n7|SMALL|10-K|20240517|edgar/data/7/0000000007-24-000001.txt\r\nbad|row\n8|ODD|N-CSR|soon|edgar/data/8/0000000008-24-000009.txt\n"


def test_index(spark):
    df = spark.createDataFrame([(INDEX.encode() + b"\xff",), (b"no separator|a|b|c|d",)], "content binary").select(decoded(F.col("content")).alias("text"))
    rows = index_entries(df, archive="https://example.org/Archives").orderBy("line_no").collect()
    assert [(r.cik, r.form_type, r.filed_date, r.accession_number) for r in rows] == [
        ("1067983", "13F-HR", date(2024, 5, 15), "0000950123-24-005622"),
        ("7", "10-K", date(2024, 5, 17), "0000000007-24-000001"),
        ("8", "N-CSR", None, "0000000008-24-000009"),
    ]
    assert rows[0].filing_directory_url == "https://example.org/Archives/edgar/data/1067983/000095012324005622"
    assert wanted(index_entries(df), ("13F-HR", "10-K"), date(2024, 5, 16), date(2024, 5, 17)).count() == 1


def test_checkpoint(spark):
    df = spark.createDataFrame([(date(2024, 5, 14), "x"), (date(2024, 5, 15), "a-000010"), (date(2024, 5, 15), "a-000011")], "filed_date date, accession_number string")
    assert [r.accession_number for r in beyond_checkpoint(df, C.Checkpoint(date(2024, 5, 15), "a-000010")).collect()] == ["a-000011"]
    assert beyond_checkpoint(df, C.Checkpoint(date(2024, 5, 15))).count() == 0
    assert beyond_checkpoint(df, C.Checkpoint(date(2024, 5, 15)), overlap_effective=True).count() == 3


def test_windows_and_urls(spark):
    today = date(2024, 5, 20)
    assert C.resolve_window("dev", today) == C.Window(date(2023, 11, 19), today)
    assert C.resolve_window("full", today).start == date(2013, 5, 20)
    assert C.resolve_window("daily", today, checkpoint=C.Checkpoint(date(2024, 5, 15))).start == date(2024, 5, 8)
    assert C.resolve_window("daily", today, start=date(2001, 1, 1)).start == date(2013, 5, 20)
    with pytest.raises(ValueError):
        C.resolve_window("daily", today, start=date(2024, 6, 1))
    assert [r.period_start for r in C.day_urls(spark, date(2024, 5, 17), date(2024, 5, 20)).collect()] == [date(2024, 5, 17), date(2024, 5, 20)]
    assert C.day_urls(spark, date(2024, 5, 17), date(2024, 5, 17)).first().url.endswith("/edgar/daily-index/2024/QTR2/master.20240517.idx")
    assert [r.url.split("full-index/")[1] for r in C.quarter_urls(spark, date(2023, 11, 5), date(2024, 4, 1)).collect()] == ["2023/QTR4/master.idx", "2024/QTR1/master.idx", "2024/QTR2/master.idx"]
    assert periodic_forms("10-K", False) == ("10-K",) and periodic_forms() == ("10-K", "10-K/A", "10-Q", "10-Q/A")


def document(kind, n, name):
    return f"<DOCUMENT>\n<TYPE>{kind}\n<SEQUENCE>{n}\n<FILENAME>{name}\n<TEXT>x</TEXT>\n</DOCUMENT>\n"


def test_submission(spark):
    text = "<ACCESSION-NUMBER>0001-24-1\n<ACCEPTANCE-DATETIME>20240515123045\n" + document("13F-HR", 1, "primary_doc.xml") + document("INFORMATION TABLE", 2, "infotable.xml") + "<DOCUMENT>\n<TYPE>13F-HR\n</DOCUMENT>"
    k = "ACCESSION NUMBER: 0002-24-2\n" + document("10-K", "x", "b.htm") + document("10-K", 2, "a.htm") + document("EX-101.INS", 3, "a.xml") + document("EX-99", 4, "note.txt")
    df = spark.createDataFrame([(text, k)], "h string, k string")
    r = df.select(header(F.col("h")).alias("a"), holdings_documents(F.lit("13F-HR"), documents(F.col("h"))).alias("b"), header(F.col("k")).alias("c"), periodic_documents(F.lit("10-K/A"), documents(F.col("k"))).alias("d"), holdings_documents(F.lit("13F-HR"), documents(F.col("k"))).alias("e"), F.size(documents(F.col("h"))).alias("n")).first()
    assert (r.a.accession_number, str(r.a.acceptance_datetime), r.n) == ("0001-24-1", "2024-05-15 12:30:45", 2)
    assert (r.b.primary.filename, r.b.info_table.filename, r.b.error) == ("primary_doc.xml", "infotable.xml", None)
    assert (r.c.accession_number, r.d.primary.filename, [x.filename for x in r.d.xbrl]) == ("0002-24-2", "a.htm", ["a.xml"])
    assert r.e.error


HTML = """<html><head><title> Annual
 Report </title><style>p{}</style><script>var a = "</p>";</script></head><body><div style="display:none"><xbrli:context id="c1"><xbrli:entity><xbrli:segment><xbrldi:explicitMember dimension="us:Axis">us:Member</xbrldi:explicitMember></xbrli:segment></xbrli:entity><xbrli:period><xbrli:startDate>2024-01-01</xbrli:startDate><xbrli:endDate>2024-12-31</xbrli:endDate></xbrli:period></xbrli:context></div>
<p>Item 1A. Risk Factors</p><p>Contents</p><ix:nonNumeric name="dei:DocumentPeriodEndDate" contextRef="c1">2024-12-31</ix:nonNumeric><ix:nonNumeric name="dei:DocumentFiscalYearFocus">2024</ix:nonNumeric>
<p>ITEM 1A - Risk&nbsp; Factors</p><p>We   may fail.</p><p>Item 7. Management's view</p><p>Revenue <ix:nonFraction name="us-gaap:Revenues" contextRef="c1" scale="6" unitRef="usd">4,250</ix:nonFraction></p></body></html>"""


def test_report(spark):
    rows = [("a", "10-K", date(2025, 2, 1), HTML.encode()), ("b", "10-Q/A", date(2025, 5, 1), b"<p>nothing"), ("c", "8-K", None, b""), ("d", "10-K", date(2025, 1, 1), None)]
    got = {r.accession_number: r for r in R.parse_reports(spark.createDataFrame(rows, "accession_number string, form_type string, filed_date date, html binary")).collect()}
    a = got["a"]
    assert (a.error, a.report_period, a.fiscal_year, a.primary_document_title, a.is_amendment) == (None, date(2024, 12, 31), 2024, "Annual Report", False)
    assert [(s.section_key, s.text_content.split("\n")[-1]) for s in a.sections] == [("risk_factors", "We may fail."), ("mda", "4,250")]
    revenue = next(f for f in a.facts if f.local_name == "Revenues")
    assert (revenue.numeric_value, revenue.namespace_prefix, revenue.period_end, revenue.dimensions_json) == (Decimal(4250000000), "us-gaap", date(2024, 12, 31), '{"us:Axis": "us:Member"}')
    assert "var a" not in a.sections[0].text_content
    assert [s.section_key for s in got["b"].sections] == ["full_text"] and got["b"].is_amendment and got["b"].report_period == date(2025, 5, 1)
    assert got["c"].error and got["d"].error is None and got["d"].chunks == []


def test_numeric_value():
    cases = [("(1,234)", None, "-1234"), ("$ 5.5 %", 3, "5500"), ("—", None, None), ("-", 2, None), ("NaN", None, None), ("Infinity", None, None), ("1e3", None, "1000"), ("2.5E-2", 3, "25"), ("12", -2, "0.12")]
    cases += [("abc", None, None), ("9" * 40, None, None), ("", None, None), ("2024", None, "2024"), (" ( 7 ) ", 1, "-70"), ("1e9999", -9990, "1000000000"), ("1e500", None, None), ("0.00000000005", None, "0.0000000001"), ("9" * 28, None, "9" * 28), ("9" * 28, 1, None), ("5", 999, None), (".5", None, "0.5"), ("1,2.3.4", None, None)]
    assert [R.numeric_value(raw, scale) for raw, scale, _ in cases] == [None if want is None else Decimal(want) for *_, want in cases]
    assert [R.whole_number(x) for x in (" 7 ", "-3", "7.0", "x", None, "2147483648")] == [7, -3, None, None, None, None]
    assert [R.day(x) for x in ("2024-02-29", " 20240229", "2023-02-29", "2024-0229", "", None)] == [date(2024, 2, 29)] * 2 + [None] * 4


def test_reader_of_odd_markup():
    """Unclosed and misnested elements, nested facts, repeated contexts and titles with markup."""
    r = R.Reader().read('<title>A<b>c</b></title><p>x<ix:nonNumeric name="a:B">one <ix:nonFraction name="c">2</ix:nonFraction> three</p></ix:nonNumeric><br>y<script>no</script></i>')
    assert r.title_text() is None and r.text() == "A\nc\nx\none\n2\nthree\ny"
    assert [(f["concept"], f["raw_value"]) for f in r.facts] == [("a:B", "one 2 three"), ("c", "2")]
    two = "".join(f'<context id="k"><entity></entity><entity><m:member dimension="d">late</m:member></entity><period><startdate>{d}</startdate><startdate>x</startdate></period></context>' for d in (1, 2))
    assert R.Reader().read(two).contexts == {"k": {"id": "k", "dimensions": {}, "entity": True, "period": True, "start": "2"}}
    assert R.Reader().read('<ix:nonnumeric name="n"/><ix:nonnumeric name="m">open').facts[1]["raw_value"] == "open"


def test_reader_counts_no_lines():
    """Lines cost time and are never asked for; tidy and untidy ends of tags close the same elements."""
    tidy, untidy = (R.Reader().read(f"<div>\n<p>a\n<ix:nonNumeric name='n'>b</ix:nonNumeric>{end}</div>c") for end in ("</p>", ""))
    assert tidy.getpos()[0] == untidy.getpos()[0] == 1
    assert tidy.text() == untidy.text() == "a\nb\nc" and tidy.facts == untidy.facts


class Slow(R.Reader):
    """Leaves every document to the standard library's parser."""

    def _read_tidy(self, html):
        return False


ODD = ["<p>", "</p>", "<DIV class='a>b'>", "</div>", "<br/>", "<title>", "</title>", "<script>", "</script>", "<style/>", "<b", ">", "<", "&amp;", "&lt;p>", "x", " a\nb ", '<ix:nonFraction name="us:A" contextRef="c1">', "</ix:nonFraction>", '<nonNumeric name="B" contextref="c&amp;2">', "</nonNumeric>", '<nonnumeric name="m"/>', '<xbrli:context id="c1">', "</xbrli:context>", "<entity>", "</entity>", "<period>", "</period>", "<instant>", "</instant>"]
ODD += ['<m:member dimension="d">', "</m:member>", "<!-- c -->", "<!-->", "<!-- a -- b -->", "<!DOCTYPE html>", "<![CDATA[x]]>", "<?xml a?>", "</ p>", '</p x="1">', "<p a=b>", "<p a='1'b='2'>", '<p a="1" a="2">', "<textarea>", "</>", '"', "-->"]


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from(ODD), max_size=15).map("".join))
def test_tidy_and_odd_documents_are_read_alike(html):
    fast, slow = R.Reader().read(html), Slow().read(html)
    assert (fast.pieces, fast.title, fast.contexts, fast.facts) == (slow.pieces, slow.title, slow.contexts, slow.facts)


def test_tidy_documents_need_no_slow_parser(monkeypatch):
    """The standard library's parser took most of the time of `report_facts` and `report_sections`."""
    want = Slow().read(HTML)
    monkeypatch.setattr(R.HTMLParser, "feed", None)
    got = R.Reader().read(HTML.replace("</p>\";", '\";'))  # its script holds markup, which is not tidy
    assert (got.title_text(), got.text(), got.contexts, got.facts) == (want.title_text(), want.text(), want.contexts, want.facts)


def test_only_what_is_asked_is_worked_out(spark, monkeypatch):
    filings = spark.createDataFrame([("a", "10-K", date(2025, 2, 1), HTML.encode()), ("b", "8-K", None, b"")], "accession_number string, form_type string, filed_date date, html binary")
    whole = {r.accession_number: r.asDict() for r in R.parse_reports(filings).collect()}
    assert whole["b"]["facts"] is None and whole["b"]["error"]
    for parts in (["facts"], ["sections"], []):
        some = R.parse_reports(filings, parts=parts)
        assert set(whole["a"]) - set(some.columns) == set(R.PARTS) - set(parts)
        assert {r.accession_number: r.asDict() for r in some.collect()} == {k: {c: w[c] for c in some.columns} for k, w in whole.items()}
    monkeypatch.setattr(R, "sections", None)  # would fail
    monkeypatch.setattr(R, "split_text", None)
    assert len(R.read_report(HTML.encode(), "10-K", None, parts=["facts"])["facts"]) == 3


@settings(max_examples=300, deadline=None)
@given(st.text("ab \n", max_size=200), st.integers(1, 40), st.integers(0, 50))
def test_chunks_cover_the_text(text, size, overlap):
    found = list(spans(text, size, overlap))
    assert {i for a, b in found for i in range(a, b)} == set(range(len(text)))
    assert all(b - a <= size for a, b in found)
    for i, c in enumerate(split_text(text, 100, size, overlap), 1):
        assert c["chunk_ordinal"] == i and text[c["char_start"] - 100 : c["char_end"] - 100] == c["chunk_text"]


def test_scalar_rules(spark):
    text = "Straße \xa0 und\t Co "
    r = spark.createDataFrame([(text, "000", "!Odd co", "a:b:c", "plain")], "a string, b string, c string, d string, e string").select(
        N.folded(N.collapse(F.col("a"))).alias("a"),
        N.tidy_cik(F.col("b")).alias("b"),
        N.primary_token(F.col("c")).alias("c"),
        *(x.alias(f"d{i}") for i, x in enumerate(N.split_concept(F.col("d")))),
        *(x.alias(f"e{i}") for i, x in enumerate(N.split_concept(F.col("e")))),
        N.parsed_date(F.lit("13/45/2024")).alias("f"),
        N.parsed_date(F.lit("05-15-2024")).alias("g"),
        N.parsed_bool(F.lit(" Yes ")).alias("h"),
        N.parsed_decimal(F.lit("1,000")).alias("i"),
        N.present(F.lit(" \t")).alias("j"),
    ).first()
    assert tuple(r) == ("strasse und co", "0", None, "a", "b:c", None, "plain", None, date(2024, 5, 15), True, None, None)


def test_case_folding(spark):
    texts = ["Straße", "ΟΔΟΣ ς", "ﬁne ﬂag", "ſtone", "ŉ ǰ ΐ", "Ꭰ ꭰ", "PLAIN", "", "İstanbul", "ẞ"]
    got = {r.t: r.f for r in spark.createDataFrame([(t,) for t in texts], "t string").select("t", N.folded(F.col("t")).alias("f")).collect()}
    assert got == {t: t.casefold() for t in texts}


def test_settings(tmp_path):
    (tmp_path / ".env").write_text("# note\nLEDGERLOOM_STORE='x y'\nLEDGERLOOM_HTTP_TIMEOUT=5\nLEDGERLOOM_EMBEDDINGS_ENABLED=yes\n")
    got = load_settings({"LEDGERLOOM_HTTP_TIMEOUT": "7.5"}, tmp_path / ".env")
    assert (got.store, got.http_timeout, got.embeddings_enabled, got.embedding_batch) == ("x y", 7.5, True, 64)
    for bad in ({"LEDGERLOOM_EMBEDDING_BATCH": "0"}, {"LEDGERLOOM_HTTP_TIMEOUT": "soon"}, {"LEDGERLOOM_EMBEDDINGS_ENABLED": "maybe"}):
        with pytest.raises(ConfigError):
            load_settings(bad, tmp_path / "none")


def test_fetcher():
    answers, slept, now = [], [], [0.0]

    def transport(url, headers, timeout):
        status = answers.pop(0)
        if status is None:
            raise OSError("down")
        return status, b"{}" if status == 200 else b""

    def sleep(seconds):
        slept.append(round(seconds, 3))
        now[0] += seconds

    fetcher = Fetcher("me", transport, per_second=5, clock=lambda: now[0], sleep=sleep)
    answers[:] = [503, None, 200]
    assert fetcher.json("u") == {}
    assert slept == [0.5, 1.0]
    answers[:] = [200]
    fetcher.get("u")
    assert slept[-1] == 0.2
    answers[:] = [403]
    assert fetcher.get("u", missing_ok=True) is None
    answers[:] = [404]
    with pytest.raises(NotFound):
        fetcher.get("u")
    answers[:] = [429, 500, 502]
    with pytest.raises(FetchError):
        fetcher.get("u")
    assert answers == []
