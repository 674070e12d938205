"""Golden rows of amendment resolution and comparison, and XML parsing."""

import os
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators.compare import compare_filer
from ledgerloom.operators.events import effective_filings, effective_holdings
from ledgerloom.operators.positions import filer_identities, filer_positions, position_changes, report_summaries
from ledgerloom.plans import ingest
from ledgerloom.plans.store import Store
from ledgerloom.schemas import ddl
from ledgerloom.scratch import scratch_path, shuffles_dropped
from ledgerloom.sources.holdings_xml import InformationTable, parse_holdings_reports, table_rows

PERIOD = date(2024, 3, 31)


def frame(spark, table, rows):
    names = [c.split()[0] for c in ddl(table).split(", ")]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], ddl(table))


def filing(cik, n, form, code, accepted, holdings, notice=False, filed=date(2024, 5, 15), period=PERIOD):
    return {"cik": cik, "accession_number": f"{cik}-24-{n:06d}", "form_type": form, "amendment_type_code": code, "acceptance_datetime": accepted, "filed_date": filed, "report_period": period, "is_notice": notice, "is_amendment": form.endswith("/A"), "company_name": f"Filer {cik}", "filing_family": "13F", "holdings": holdings}


def at(day, hour):
    return datetime(2024, 5, day, hour)


def tables(spark, filings):
    holdings = [{"accession_number": f["accession_number"], "holding_sequence": i, "security_reference_key": k, "issuer_name": k, "value_usd": Decimal(v), "value_reported": Decimal(v), "shares_principal_amount": Decimal(s), "shares_principal_type": t, "put_call": p} for f in filings for i, (k, v, s, t, p) in enumerate(f["holdings"], 1)]
    return frame(spark, "filings", filings), frame(spark, "thirteenf_filings", filings), frame(spark, "thirteenf_holdings", holdings)


def lines(*pairs):
    return [(k, v, 1, "SH", None) for k, v in pairs]


@pytest.fixture(scope="module")
def amended(spark):
    return tables(
        spark,
        [
            # Two supplements in a row, one of them between; a correction of no known kind last.
            filing("41", 1, "13F-HR", None, at(2, 9), lines(("oak", 11), ("elm", 7))),
            filing("41", 2, "13F-HR/A", "NEW HOLDINGS", at(3, 9), lines(("ash", 5))),
            filing("41", 3, "13F-HR/A", "NEW HOLDINGS", at(9, 9), lines(("fir", 2), ("ash", 1))),
            filing("41", 4, "13F-HR/A", "UNKNOWN_AMENDMENT_TYPE", at(10, 9), lines(("yew", 99))),
            # Restated twice; what was added before the last time is gone, what came after it counts.
            filing("42", 1, "13F-HR/A", "RESTATEMENT", at(4, 8), lines(("oak", 3))),
            filing("42", 2, "13F-HR/A", "NEW HOLDINGS", at(5, 8), lines(("elm", 4))),
            filing("42", 3, "13F-HR", None, at(6, 8), lines(("fir", 6))),
            filing("42", 4, "13F-HR/A", "NEW HOLDINGS", at(7, 8), lines(("ash", 8))),
            # Only a supplement, of nothing.
            filing("43", 1, "13F-HR/A", "NEW HOLDINGS", at(1, 7), lines(("oak", 1))),
        ],
    )


def test_effective_holdings(amended):
    got = {(r.cik, r.security_reference_key, int(r.value_usd)) for r in effective_holdings(*amended).collect()}
    assert got == {("41", "oak", 11), ("41", "elm", 7), ("41", "ash", 5), ("41", "ash", 1), ("41", "fir", 2), ("42", "fir", 6), ("42", "ash", 8)}


def test_effective_filings(spark, amended):
    got = {(r.cik, r.accession_number[-1]) for r in effective_filings(*amended[:2]).collect()}
    assert got == {("41", "3"), ("42", "4")}
    both = tables(spark, [filing("1", 1, "13F-HR", None, None, []), filing("1", 2, "13F-HR", None, None, []), filing("1", 3, "13F-NT", None, at(20, 1), [], notice=True)])
    assert {(r.is_notice, r.accession_number[-1]) for r in effective_filings(*both[:2]).collect()} == {(False, "2"), (True, "3")}


def test_replay_of_events(spark):
    """Effective members against a replay, event by event."""
    import random

    from ledgerloom.operators.events import effective_members, latest_effective

    rnd = random.Random(2)
    rows = [(g, rnd.randrange(4), n, rnd.choice(["RESET", "SUPPLEMENT", None])) for g in range(60) for n in range(rnd.randrange(7))]
    df = spark.createDataFrame(rows, "g int, t int, n int, kind string")
    want, latest = set(), set()
    for g in range(60):
        state = None
        for row in sorted((r for r in rows if r[0] == g), key=lambda r: (r[1], r[2])):
            if row[3] == "RESET":
                state = [row]
            elif row[3] == "SUPPLEMENT" and state is not None:
                state.append(row)
        want |= set(state or [])
        latest |= {state[-1]} if state else set()
    assert {tuple(r) for r in effective_members(df, ["g"], ["t", "n"]).collect()} == want
    assert {tuple(r) for r in latest_effective(df, ["g"], ["t", "n"]).collect()} == latest


PRIOR, CURRENT = date(2025, 9, 30), date(2025, 12, 31)
SEEDS = {
    PRIOR: [("exact-co-com", "EXACT CO", "COM", "123456789", "BBG000000001", 100, 10), ("bank-amer-corp", "BANK AMER CORP", "COM", "060505104", None, 100, 1000), ("liberty-live-c-old", "LIBERTY MEDIA CORP DEL", "COM LBTY LIV S C", "531229722", None, 1058, 10917661), ("liberty-formula-c", "LIBERTY MEDIA CORP DEL", "COM SER C FRMLA", "531229854", None, 315, 3018555)],
    CURRENT: [("exact-co-com", "EXACT CO", "COM", "123456789", "BBG000000001", 150, 15), ("bank-america-corp", "BANK AMERICA CORP", "COM", "060505104", None, 90, 900), ("liberty-live-c-new", "LIBERTY LIVE HOLDINGS INC", "COM SHS SER C", "530909308", None, 908, 10917661), ("liberty-one-c", "LIBERTY MEDIA CORP DEL", "COM LBTY ONE S C", "531229755", None, 297, 3018555)],
}


def portfolio(spark, seeds, option=None):
    filings = [filing("1067983", i, "13F-HR", None, at(15, i), [(s[0], s[5], s[6], "SH", option) for s in rows], period=period) for i, (period, rows) in enumerate(seeds.items(), 1)]
    f, t, h = tables(spark, filings)
    securities = frame(spark, "security_references", [dict(zip(("security_reference_key", "issuer_name", "class_title", "cusip", "figi"), s[:5], strict=True)) for s in {s[0]: s for rows in seeds.values() for s in rows}.values()])
    filers = frame(spark, "filers", [{"cik": "1067983", "filer_name": ""}])
    return filer_positions(effective_holdings(f, t, h), filer_identities(filers, f, t), securities), effective_filings(f, t)


def test_compare(spark):
    positions, effective = portfolio(spark, SEEDS)
    got = {(r.issuer_name, int(r.value_change_usd), int(r.share_change), r.match_strategy) for r in compare_filer(positions, effective, "1067983", "2025-12-31", "2025-09-30").collect()}
    renamed = "issuer_or_primary_token_same_shares"
    assert got == {("EXACT CO", 50, 5, "exact_security_reference_key"), ("BANK AMERICA CORP", -10, -100, "figi_or_cusip"), ("LIBERTY LIVE HOLDINGS INC", -150, 0, renamed), ("LIBERTY MEDIA CORP DEL", -18, 0, renamed)}
    assert compare_filer(positions, effective, "1067983", "2025-12-31", "2025-09-30", "options_only").count() == 0
    assert compare_filer(positions, effective, "1067983", "2025-12-31", "2025-09-30", "nonsense").count() == 0


def test_compare_conserves_rows(spark):
    """With strict keys every position appears exactly once, whatever the candidates."""
    import random

    rnd = random.Random(4)
    seeds = {p: [(f"k{i}", rnd.choice(["A CO", "A B", "!odd", "C CO"]), "COM", rnd.choice(["1", "2", "3", ""]), None, rnd.randrange(50, 150), rnd.choice([5, 7, 0])) for i in rnd.sample(range(40), 25)] for p in (PRIOR, CURRENT)}
    seeds[CURRENT] = [next((q for q in seeds[PRIOR] if q[0] == s[0]), s)[:5] + s[5:] for s in seeds[CURRENT]]
    positions, effective = portfolio(spark, seeds)
    got = compare_filer(positions, effective, "1067983", "2025-12-31", "2025-09-30", strict_keys=True).collect()
    assert sorted(r.security_reference_key for r in got if not r.disposed_position) == sorted(s[0] for s in seeds[CURRENT])
    assert sorted(r.previous_security_reference_key for r in got if not r.new_position) == sorted(s[0] for s in seeds[PRIOR])


def test_changes_and_identities(spark):
    positions, _ = portfolio(spark, SEEDS)
    rows = {(r.security_reference_key, r.report_period): r for r in position_changes(positions).collect()}
    exact = rows["exact-co-com", CURRENT]
    assert (exact.previous_report_period, exact.delta_value_usd, exact.delta_shares_principal_amount) == (PRIOR, 50, 5)
    assert rows["liberty-one-c", CURRENT].previous_report_period is None and rows["liberty-one-c", CURRENT].previous_value_usd == 0
    filers = frame(spark, "filers", [{"cik": "9", "filer_name": "Nine"}])
    lone = filer_identities(filers, frame(spark, "filings", []), frame(spark, "thirteenf_filings", [])).first()
    assert (lone.canonical_filer_name, lone.company_name_aliases, lone.filing_manager_aliases) == ("Nine", [], [])


def test_summaries(spark):
    filings = frame(spark, "filings", [filing(c, 1, "10-K", None, None, []) | {"period_of_report": PERIOD} for c in ("1", "2")])
    reports = frame(spark, "periodic_reports", [{"accession_number": f"{c}-24-000001"} for c in ("1", "2")])
    tickers = spark.createDataFrame([("1", "ZED", "ZED"), ("1", "ABC", "ABC")], ddl("company_tickers"))
    got = {r.cik: r for r in report_summaries(reports, filings, tickers).collect()}
    assert (got["1"].ticker, got["1"].tickers, got["1"].report_period) == ("ABC", ["ABC", "ZED"], PERIOD)
    assert got["2"].tickers is None


COVER = """<?xml version="1.0"?><n:report xmlns:n="http://example.org/a"><n:headerData><n:submissionType>{form}</n:submissionType><n:filerInfo><n:periodOfReport>03-31-2024</n:periodOfReport></n:filerInfo></n:headerData>
<n:formData><n:coverPage><n:reportCalendarOrQuarter>03-31-2024</n:reportCalendarOrQuarter><n:isAmendment>{flag}</n:isAmendment><n:amendmentType>{kind}</n:amendmentType>
<n:filingManager><n:name> Big  Manager </n:name><n:address><n:city>Omaha</n:city></n:address></n:filingManager></n:coverPage>
<n:otherManagersInfo><n:otherManager><n:sequenceNumber>1</n:sequenceNumber><n:name>Other</n:name></n:otherManager></n:otherManagersInfo>
<n:summaryPage><n:tableEntryTotal>2</n:tableEntryTotal><n:tableValueTotal>450</n:tableValueTotal></n:summaryPage></n:formData></n:report>"""
ROWS = """<informationTable xmlns="http://example.org/b"><infoTable><nameOfIssuer>APPLE INC</nameOfIssuer><titleOfClass>COM</titleOfClass><cusip>037833100</cusip><figi>BBG000B9XRY4</figi><value>150</value><shrsOrPrnAmt><sshPrnamt>10</sshPrnamt><sshPrnamtType>SH</sshPrnamtType></shrsOrPrnAmt><investmentDiscretion>SOLE</investmentDiscretion><votingAuthority><Sole>10</Sole><Shared>0</Shared><None>0</None></votingAuthority></infoTable>
<infoTable><nameOfIssuer>NVIDIA CORP</nameOfIssuer><titleOfClass>COM</titleOfClass><cusip>67066G104</cusip><value>50</value><putCall>PUT</putCall></infoTable></informationTable>"""


def test_xml(spark):
    new, old = date(2024, 5, 15), date(2022, 5, 15)
    cases = [
        ("a", "13F-HR", new, COVER.format(form="13F-HR", flag="false", kind=""), ROWS),
        ("b", "13F-HR", old, COVER.format(form="13F-HR", flag="N", kind=""), ROWS),
        ("c", "13F-HR/A", new, COVER.format(form="13F-HR/A", flag="true", kind=" new   holdings "), ROWS),
        ("d", "13F-HR/A", new, COVER.format(form="13F-HR/A", flag="true", kind="CORRECTION"), ROWS),
        ("e", "13F-NT", new, COVER.format(form="13F-NT", flag="false", kind=""), None),
        ("f", "13F-HR", new, "this is not XML", ROWS),
        ("g", "13F-HR", new, COVER.replace("03-31-2024", "someday").format(form="13F-HR", flag="", kind=""), ROWS),
        ("h", "13F-HR", new, None, None),
        ("i", "13F-HR", new, COVER.format(form="13F-HR", flag="false", kind=""), ROWS.replace(">50<", ">1,000<")),
        ("j", "13F-HR", new, COVER.replace("<n:tableValueTotal>450", "<n:tableValueTotal>4,50").format(form="13F-HR", flag="false", kind=""), ROWS),
    ]
    df = spark.createDataFrame([(n, f, d, p and p.encode(), i and i.encode()) for n, f, d, p, i in cases], "accession_number string, form_type string, filed_date date, primary_xml binary, info_xml binary")
    got = {r.accession_number: r for r in parse_holdings_reports(df).collect()}
    a = got["a"]
    assert (a.error, a.report_period, a.is_amendment, a.amendment_type_code, a.filing_manager_name, a.city, a.table_entry_total) == (None, PERIOD, False, None, "Big  Manager", "Omaha", 2)
    assert [(h.holding_sequence, h.issuer_name, h.value_usd, h.put_call, h.value_unit) for h in a.holdings] == [(1, "APPLE INC", 150, None, "USD"), (2, "NVIDIA CORP", 50, "PUT", "USD")]
    assert a.other_managers[0].manager_name == "Other" and len(a.other_managers) == 1
    assert got["b"].holdings[0].value_usd == 150000 and got["b"].table_value_total_unit == "THOUSANDS_USD"
    assert (got["c"].amendment_type_code, got["d"].amendment_type_code) == ("NEW HOLDINGS", "UNKNOWN_AMENDMENT_TYPE")
    assert got["e"].is_notice and got["e"].holdings == [] and got["e"].error is None
    assert all(got[k].error for k in "fghij")
    assert (got["i"].error, got["j"].error) == ("a holding has an invalid number", "invalid table_value_total")


PLAIN_COVER = "<edgarSubmission><headerData><filerInfo><periodOfReport>03-31-2024</periodOfReport></filerInfo></headerData></edgarSubmission>"
ONE_LINE = "<nameOfIssuer>A</nameOfIssuer><titleOfClass>B</titleOfClass><cusip>C</cusip>"


def test_tables_are_parsed_once_when_errors_are_left_out(spark):
    """A filter on the error is not copied below a shuffle together with the parser."""
    made = spark.createDataFrame([("a", "13F-HR", date(2024, 5, 1), PLAIN_COVER, f"<t><infoTable>{ONE_LINE}</infoTable></t>")], "accession_number string, form_type string, filed_date date, primary_xml string, info_xml string").repartition(3)
    found = parse_holdings_reports(made).where("error IS NULL").select("accession_number", "holdings")
    assert found._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython") == 1
    assert [len(r.holdings) for r in found.collect()] == [1]


def test_a_table_in_an_unknown_encoding_is_its_own_error(spark):
    rows = [(k, "13F-HR", date(2024, 5, 1), PLAIN_COVER.encode(), f'<?xml version="1.0" encoding="{e}"?><t><infoTable>{ONE_LINE}</infoTable></t>'.encode()) for k, e in (("a", "nope"), ("b", "utf-8"))]
    made = spark.createDataFrame(rows, "accession_number string, form_type string, filed_date date, primary_xml binary, info_xml binary")
    assert {r.accession_number: r.error for r in parse_holdings_reports(made).collect()} == {"a": "information table is not XML", "b": None}


def test_trees_and_events_give_the_same_texts():
    places = ["nameOfIssuer", "titleOfClass", "cusip", "figi", "shrsOrPrnAmt/sshPrnamtType", "putCall", "investmentDiscretion", "otherManager", "value", "shrsOrPrnAmt/sshPrnamt", "votingAuthority/Sole", "votingAuthority/Shared", "votingAuthority/None"]
    odd = ["<cusip> x <i>y</i> z </cusip>", "<cusip>1</cusip><cusip/>", "<cusip>a<!-- b -->c</cusip>", "<cusip><![CDATA[ <d> ]]></cusip>", "<value>1<cusip>2</cusip></value>", "<n:cusip>undeclared</n:cusip>", "<shrsOrPrnAmt>q<sshPrnamt> 7 </sshPrnamt></shrsOrPrnAmt>", "<votingAuthority><Sole>1</Sole><None/></votingAuthority>"]
    for one in odd:
        xml = f"<t xmlns='urn:a'><other>{ONE_LINE}</other><infoTable>{one}</infoTable><infoTable/></t>".encode()
        assert table_rows(xml, "utf-8") == [[row.get(p) or None for p in places] for row in InformationTable().read(xml, "utf-8")]


def staged_folders(spark):
    place = scratch_path(spark, "x").rpartition("/")[0].removeprefix("file:").replace("//", "/")
    return {n for n in os.listdir(place) if n.startswith("staged-")} if os.path.isdir(place) else set()


def test_a_load_leaves_no_staged_filings_and_no_shuffle_files(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/store", parts=2)
    store.migrate()
    rows = [(str(i), "13F-HR", date(2024, 5, 1), PLAIN_COVER, f"<t><infoTable>{ONE_LINE}</infoTable></t>", "1", "Filer", i) for i in range(20)]
    made = spark.createDataFrame(rows, "accession_number string, form_type string, filed_date date, primary_xml string, info_xml string, cik string, company_name string, place int")
    made = made.withColumns({c: F.lit(None).cast("string") for c in ("archive_path", "submission_url", "filing_directory_url", "index_url", "primary_document_filename", "information_table_filename")} | {"acceptance_datetime": F.lit(None).cast("timestamp")})
    before, setting = staged_folders(spark), spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    with store.commit():
        good, bad, stale = ingest.load_filings(store, ingest.HOLDINGS, parse_holdings_reports(made.repartition(3)), None)
    assert (good, bad, [r.cik for r in stale.collect()]) == (20, 0, ["1"])
    assert len(staged_folders(spark) - before) == 1  # the filers, which are given back
    assert store.read("thirteenf_holdings").count() == 20
    with shuffles_dropped(spark):
        assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "true"
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == setting
