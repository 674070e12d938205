"""Filings operators on filings made of the driver's tables, and the same in SQL.

Orders play filings (customer and quarter are filer and report period, the
priority is the kind of filing), their line items play holdings, parts play
securities. Texts (indexes, submission envelopes, XML, HTML) are written out of
those rows on the Spark side and parsed back by the operators; SQL gives what
the rows held.
"""

from __future__ import annotations

from dataclasses import replace
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import normalise as N
from .operators import compare, embedding, events, positions, upsert
from .plans import acquire, backfill, ingest
from .plans.refresh import refresh_views
from .plans.store import Store
from .queries import SQL, dealt, query, table
from .schemas import ddl
from .scratch import scratch_path, staged
from .sources import artifacts, holdings_xml, index, reports, submission
from .streaming import incremental

E, C, L = F.expr, F.col, F.lit

# ---- the filings ----------------------------------------------------------------------------------------------------------

_FORM = "CASE o_orderpriority WHEN '1-URGENT' THEN '13F-HR' WHEN '4-NOT SPECIFIED' THEN '13F-NT' ELSE '13F-HR/A' END"
_CODE = "CASE o_orderpriority WHEN '2-HIGH' THEN 'RESTATEMENT' WHEN '3-MEDIUM' THEN 'NEW HOLDINGS' WHEN '5-LOW' THEN 'UNKNOWN_AMENDMENT_TYPE' END"
_FILER, _KEY = "CAST(o_custkey % 40 AS {s})", "lpad(CAST(o_orderkey AS {s}), 10, '0')"
_PERIOD = "CAST(date_trunc('quarter', o_orderdate) - INTERVAL 1 DAY AS DATE)"


def _both(text: str) -> tuple[str, str]:
    """A template's forms for Spark and for the other engine."""
    return text.replace("{s}", "STRING"), text.replace("{s}", "VARCHAR")


_FILINGS = _both(f"""SELECT {_KEY} AS accession_number, {_FILER} AS cik, concat('Company ', {_FILER}, ' ', o_orderpriority) AS company_name,
    CASE WHEN o_orderstatus = 'P' THEN 'PERIODIC_REPORTS' ELSE '13F' END AS filing_family, {_FORM} AS form_type, CAST(o_orderdate AS DATE) AS filed_date,
    CASE WHEN o_orderkey % 3 > 0 THEN o_orderdate + INTERVAL 1 HOUR * CAST(o_orderkey % 20 AS INT) END AS acceptance_datetime, {_PERIOD} AS period_of_report,
    concat('edgar/data/', {_FILER}, '/', {_KEY}, '.txt') AS archive_path, 'u' AS submission_url, 'd' AS filing_directory_url, 'p.htm' AS primary_document_filename FROM orders""")
_HOLDERS = _both(f"""SELECT {_KEY} AS accession_number, {_PERIOD} AS report_period, {_PERIOD} AS report_calendar_or_quarter,
    CASE WHEN o_orderkey % 5 > 0 THEN concat('Manager ', CAST(o_custkey % 3 AS {{s}})) END AS filing_manager_name, o_orderpriority = '4-NOT SPECIFIED' AS is_notice,
    o_orderpriority IN ('2-HIGH', '3-MEDIUM', '5-LOW') AS is_amendment, {_CODE} AS amendment_type_code, CAST(o_orderkey % 7 AS INT) AS table_entry_total, CAST(o_totalprice AS DECIMAL(20,2)) AS table_value_total_usd FROM orders""")
_HOLDINGS = _both("""SELECT lpad(CAST(l_orderkey AS {s}), 10, '0') AS accession_number, CAST(l_partkey AS {s}) AS security_reference_key,
    CASE l_returnflag WHEN 'R' THEN 'PUT' WHEN 'A' THEN 'CALL' END AS put_call, CASE WHEN l_linestatus = 'O' THEN 'SH' END AS shares_principal_type,
    CAST(l_extendedprice AS DECIMAL(20,2)) AS value_usd, CASE WHEN l_linenumber <> 2 THEN CAST(l_extendedprice / 1000 AS DECIMAL(20,2)) END AS value_reported, CAST(l_quantity AS DECIMAL(20,2)) AS shares_principal_amount FROM lineitem""")
_SECURITIES = _both("SELECT CAST(p_partkey AS {s}) AS security_reference_key, p_name AS issuer_name, p_type AS class_title, concat(p_brand, '-', CAST(p_size AS {s})) AS cusip, CASE WHEN p_size < 0 THEN '' END AS figi FROM part")
_FILERS = _both("SELECT CAST(k AS {s}) AS cik, CASE WHEN k % 4 > 0 THEN concat('Filer ', CAST(k AS {s})) ELSE '' END AS filer_name, DATE '2000-01-01' AS first_seen_filed_date, DATE '2001-01-01' AS last_seen_filed_date FROM (SELECT DISTINCT c_custkey % 45 AS k FROM customer) AS x")


def _made(spark: SparkSession, sf_dir: str, sql: tuple[str, str], of: str) -> DataFrame:
    return spark.sql(sql[0].replace(f"FROM {of}", "FROM {source}"), source=table(spark, sf_dir, of))


def filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _made(spark, sf_dir, _FILINGS, "orders")


def holders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _made(spark, sf_dir, _HOLDERS, "orders")


def securities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _made(spark, sf_dir, _SECURITIES, "part")


_WORLD = f"""f AS ({_FILINGS[1]}), t AS ({_HOLDERS[1]}), h AS ({_HOLDINGS[1]}), s AS ({_SECURITIES[1]}), fl AS ({_FILERS[1]}),
    ev AS (SELECT t.*, f.cik, f.company_name, f.form_type, f.filed_date, f.acceptance_datetime, coalesce(f.acceptance_datetime, f.filed_date::TIMESTAMP) AS moment,
        form_type = '13F-HR' OR (form_type = '13F-HR/A' AND amendment_type_code = 'RESTATEMENT') AS reset, form_type = '13F-HR/A' AND amendment_type_code = 'NEW HOLDINGS' AS more FROM t JOIN f USING (accession_number)),
    grp AS (SELECT *, sum(reset::INT) OVER w AS g, sum(reset::INT) OVER (PARTITION BY cik, report_period) AS last FROM ev WHERE NOT is_notice WINDOW w AS (PARTITION BY cik, report_period ORDER BY moment, accession_number ROWS UNBOUNDED PRECEDING)),
    mem AS (SELECT * FROM grp WHERE last > 0 AND g = last AND (reset OR coalesce(more, false))),
    eff AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY cik, report_period ORDER BY moment DESC, accession_number DESC) AS rn FROM mem) WHERE rn = 1),
    nt AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY cik, report_period ORDER BY moment DESC, accession_number DESC) AS rn FROM ev WHERE is_notice) WHERE rn = 1),
    eh AS (SELECT m.cik, m.company_name, m.report_period, m.filing_manager_name, h.* FROM mem m JOIN h USING (accession_number)),
    al AS (SELECT f.cik, min(company_name) AS least, list_sort(list(DISTINCT company_name)) AS names, list_sort(coalesce(list(DISTINCT filing_manager_name) FILTER (WHERE filing_manager_name IS NOT NULL), [])) AS managers
        FROM f LEFT JOIN t USING (accession_number) WHERE filing_family = '13F' GROUP BY f.cik),
    idn AS (SELECT cik, coalesce(nullif(filer_name, ''), least) AS canonical_filer_name, first_seen_filed_date, last_seen_filed_date, coalesce(names, []) AS names, coalesce(managers, []) AS managers FROM fl LEFT JOIN al USING (cik)),
    pos AS (SELECT report_period, cik, coalesce(any_value(canonical_filer_name), max(filing_manager_name), max(company_name)) AS canonical_filer_name, security_reference_key, any_value(issuer_name) AS issuer_name, any_value(cusip) AS cusip,
        coalesce(put_call, 'NONE') AS put_call_key, coalesce(shares_principal_type, 'UNKNOWN') AS shares_principal_type_key, sum(value_usd)::DECIMAL(38,2) AS total_value_usd, coalesce(sum(value_reported), 0)::DECIMAL(38,2) AS total_value_reported,
        sum(shares_principal_amount)::DECIMAL(38,2) AS total_shares_principal_amount, count(*) AS source_row_count FROM eh JOIN s USING (security_reference_key) LEFT JOIN idn USING (cik)
        GROUP BY report_period, cik, security_reference_key, coalesce(put_call, 'NONE'), coalesce(shares_principal_type, 'UNKNOWN'))"""


@query(f"WITH {_WORLD} SELECT accession_number, cik, report_period, is_notice, table_entry_total FROM (SELECT * FROM eff UNION ALL BY NAME SELECT * FROM nt)")
def filing_effective(spark: SparkSession, sf_dir: str) -> DataFrame:
    """VIW-01, JON-01, SET-01: `effective_filings`."""
    return events.effective_filings(filings(spark, sf_dir), holders(spark, sf_dir)).select("accession_number", "cik", "report_period", "is_notice", "table_entry_total")


def effective(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.effective_holdings(filings(spark, sf_dir), holders(spark, sf_dir), _made(spark, sf_dir, _HOLDINGS, "lineitem"))


@query(f"WITH {_WORLD} SELECT accession_number, cik, report_period, security_reference_key, put_call, value_usd FROM eh")
def filing_holdings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """VIW-02, JON-02: `effective_holdings`."""
    return effective(spark, sf_dir).select("accession_number", "cik", "report_period", "security_reference_key", "put_call", "value_usd")


def identities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return positions.filer_identities(_made(spark, sf_dir, _FILERS, "customer"), filings(spark, sf_dir), holders(spark, sf_dir))


@query(f"WITH {_WORLD} SELECT cik, canonical_filer_name, first_seen_filed_date, last_seen_filed_date, array_to_string(names, '|') AS companies, array_to_string(managers, '|') AS managers FROM idn")
def filing_identities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """VIW-03, JON-03, AGG-02: `filer_identities`."""
    got = identities(spark, sf_dir)
    return got.select("cik", "canonical_filer_name", "first_seen_filed_date", "last_seen_filed_date", F.array_join("company_name_aliases", "|").alias("companies"), F.array_join("filing_manager_aliases", "|").alias("managers"))


def held(spark: SparkSession, sf_dir: str) -> DataFrame:
    return positions.filer_positions(effective(spark, sf_dir), identities(spark, sf_dir), securities(spark, sf_dir))


_HELD = ["report_period", "cik", "canonical_filer_name", "security_reference_key", "issuer_name", "cusip", "put_call_key", "shares_principal_type_key", "total_value_usd", "total_value_reported", "total_shares_principal_amount", "source_row_count"]


@query(f"WITH {_WORLD} SELECT {', '.join(_HELD)} FROM pos")
def filing_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """VIW-04, JON-04, AGG-01: `filer_positions`."""
    return held(spark, sf_dir).select(*_HELD)


@query(f"""WITH {_WORLD}, w AS (SELECT *, lag(report_period) OVER k AS before, coalesce(lag(total_value_usd) OVER k, 0)::DECIMAL(38,2) AS pv, coalesce(lag(total_shares_principal_amount) OVER k, 0)::DECIMAL(38,2) AS ps FROM pos
    WINDOW k AS (PARTITION BY cik, security_reference_key, put_call_key, shares_principal_type_key ORDER BY report_period))
    SELECT report_period, before AS previous_report_period, cik, security_reference_key, put_call_key, shares_principal_type_key, total_value_usd AS current_value_usd, pv AS previous_value_usd, (total_value_usd - pv)::DECIMAL(38,2) AS delta_value_usd,
    (total_shares_principal_amount - ps)::DECIMAL(38,2) AS delta_shares_principal_amount FROM w""")
def filing_position_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """VIW-05, WIN-05: `position_changes`."""
    names = ["report_period", "previous_report_period", "cik", "security_reference_key", "put_call_key", "shares_principal_type_key", "current_value_usd", "previous_value_usd", "delta_value_usd", "delta_shares_principal_amount"]
    return positions.position_changes(held(spark, sf_dir)).select(*names)


@query(f"WITH {_WORLD} SELECT pos.cik, pos.report_period, pos.security_reference_key, pos.put_call_key, pos.shares_principal_type_key, eff.accession_number FROM pos LEFT JOIN eff ON eff.cik = pos.cik AND eff.report_period = pos.report_period")
def filing_provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JON-10: `with_provenance`."""
    found = compare.with_provenance(held(spark, sf_dir), events.effective_filings(filings(spark, sf_dir), holders(spark, sf_dir)))
    return found.select("cik", "report_period", "security_reference_key", "put_call_key", "shares_principal_type_key", "accession_number")


_TICKERS = _both("SELECT CAST(n_nationkey * 2 AS {s}) AS cik, concat(substr(n_name, 1, 3), CAST(r AS {s})) AS ticker, upper(concat(substr(n_name, 1, 3), CAST(r AS {s}))) AS ticker_upper FROM nation, (SELECT 1 AS r UNION ALL SELECT 2) AS x")
_REPORTS = _both(f"""SELECT {_KEY} AS accession_number, CASE WHEN o_orderkey % 4 > 0 THEN {_PERIOD} END AS report_period, CAST(year(o_orderdate) AS INT) AS fiscal_year, 'Q1' AS fiscal_period, false AS is_amendment,
    'title' AS primary_document_title, 1 AS section_count, 2 AS chunk_count, 3 AS xbrl_fact_count FROM orders""")


def tickers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _made(spark, sf_dir, _TICKERS, "nation")


@query(f"""WITH f AS ({_FILINGS[1]}), r AS ({_REPORTS[1]}), t AS ({_TICKERS[1]}) SELECT r.accession_number, f.cik, (SELECT min(ticker) FROM t WHERE t.cik = f.cik) AS ticker,
    (SELECT string_agg(DISTINCT ticker, '|' ORDER BY ticker) FROM t WHERE t.cik = f.cik) AS tickers, coalesce(r.report_period, f.period_of_report) AS report_period, form_type, fiscal_year FROM r JOIN f USING (accession_number)""")
def filing_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """VIW-07, JON-11, AGG-03: `report_summaries`."""
    made = _made(spark, sf_dir, _REPORTS, "orders").withColumn("ingest_seq", L(1))
    got = positions.report_summaries(made, filings(spark, sf_dir), tickers(spark, sf_dir))
    return got.select("accession_number", "cik", "ticker", F.array_join("tickers", "|").alias("tickers"), "report_period", "form_type", "fiscal_year")


# ---- embeddings -----------------------------------------------------------------------------------------------------------

_CHUNKS = _both("""SELECT concat('k', lpad(CAST(doc_id AS {s}), 9, '0')) AS chunk_key, lpad(CAST(doc_id % 1000 AS {s}), 10, '0') AS accession_number, lang AS section_key, 'I' AS item_label, source AS section_title, CAST(doc_id % 9 AS INT) AS chunk_ordinal,
    text AS chunk_text, sha2_256(text) AS content_hash FROM documents""")
_PARTS = "'Company: ' || company_name, 'CIK: ' || cik, 'Ticker: ' || coalesce(ticker, 'unknown'), 'Form: ' || form_type, 'Filed date: ' || filed_date::VARCHAR, 'Report period: ' || report_period::VARCHAR, 'Accession: ' || accession_number, 'Section: ' || coalesce(section_key, 'None') || ' - ' || coalesce(section_title, 'None'), 'Item: ' || item_label, 'Chunk ordinal: ' || chunk_ordinal::VARCHAR, '', coalesce(chunk_text, 'None')"


@query(f"""WITH f AS ({_FILINGS[1]}), r AS ({_REPORTS[1]}), t AS ({_TICKERS[1]}), c AS ({_CHUNKS[1].replace("sha2_256(", "sha256(")}),
    j AS (SELECT c.*, f.company_name, f.cik, f.form_type, f.filed_date, coalesce(r.report_period, f.period_of_report) AS report_period, (SELECT min(ticker) FROM t WHERE t.cik = f.cik) AS ticker FROM c JOIN f USING (accession_number) JOIN r USING (accession_number)
        WHERE f.form_type IN ('13F-HR', '13F-HR/A') AND f.filed_date BETWEEN DATE '1995-06-01' AND DATE '1999-12-31' AND EXISTS (SELECT 1 FROM t WHERE t.cik = f.cik AND upper(t.ticker) LIKE '%1'))
    SELECT chunk_key, sha256('periodic-chunk-v1' || chr(10) || concat_ws(chr(10), {_PARTS})) AS input_hash, coalesce(l.quality, 0) <> 1 AS needed
    FROM j LEFT JOIN labels l ON 'k' || lpad(l.doc_id::VARCHAR, 9, '0') = chunk_key AND l.quality = 1 WHERE chunk_key > 'k000000020'""")
def filing_embedding_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TXT-13, FLT-05, FLT-08, FLT-09, FLT-13, JON-12, JON-13: `candidates`; a chunk with a good label has the embedding of its present input."""
    symbols = tickers(spark, sf_dir)
    chunks = spark.sql(_CHUNKS[0].replace("FROM documents", "FROM {source}").replace("sha2_256(text)", "sha2(text, 256)"), source=table(spark, sf_dir, "documents"))
    made, filed = _made(spark, sf_dir, _REPORTS, "orders"), filings(spark, sf_dir)
    chosen = embedding.Selection(form_type="13F-HR", filed_from=date(1995, 6, 1), filed_to=date(1999, 12, 31), after_key="k000000020")
    profile = embedding.Profile(embedding_dimension=8)
    none = spark.createDataFrame([], "chunk_key string, profile_name string, content_hash string, embedding_input_hash string")
    some = filed.join(symbols.where(C("ticker").endswith("1")), "cik", "left_semi")
    first = embedding.candidates(chunks, some, made, symbols, none, profile, chosen)
    good = table(spark, sf_dir, "labels").where("quality = 1").select(F.concat(L("k"), F.lpad(C("doc_id").cast("string"), 9, "0")).alias("chunk_key"))
    known = first.join(good, "chunk_key", "left_semi").select("chunk_key", L("default").alias("profile_name"), "content_hash", "embedding_input_hash")
    return embedding.candidates(chunks, some, made, symbols, known, profile, chosen).select("chunk_key", C("embedding_input_hash").alias("input_hash"), "needed")


_CHOSEN = f"""f AS ({_FILINGS[1]}), r AS ({_REPORTS[1]}), t AS ({_TICKERS[1]}), c AS ({_CHUNKS[1].replace("sha2_256(", "sha256(")}),
    j AS (SELECT c.*, f.company_name, f.cik, f.form_type, f.filed_date, coalesce(r.report_period, f.period_of_report) AS report_period, (SELECT min(ticker) FROM t WHERE t.cik = f.cik) AS ticker FROM c JOIN f USING (accession_number) JOIN r USING (accession_number)
        WHERE f.form_type IN ('13F-HR', '13F-HR/A') AND f.filed_date BETWEEN DATE '1995-06-01' AND DATE '1999-12-31')"""


@query(f"WITH {_CHOSEN} SELECT chunk_key, profile_name, sha256('periodic-chunk-v1' || chr(10) || concat_ws(chr(10), {_PARTS})) AS input_hash FROM j, (VALUES ('first'), ('second')) p(profile_name) WHERE profile_name = 'second' OR chunk_key <= (SELECT chunk_key FROM j ORDER BY chunk_key LIMIT 1 OFFSET 24)")
def backfill_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TXT-14, TXT-15, SNK-13 to SNK-15, SRT-09: a profile stops at its limit, another embeds everything in lots; the first then changes, which drops what it had, and stops at its limit again."""
    store = Store(spark, f"{scratch_path(spark, 'backfill')}/store")
    store.migrate()
    chunks = spark.sql(_CHUNKS[0].replace("FROM documents", "FROM {source}").replace("sha2_256(text)", "sha2(text, 256)"), source=table(spark, sf_dir, "documents"))
    with store.commit():
        store.upsert("filings", _filled(filings(spark, sf_dir).withColumn("ingest_seq", L(1)), "filings"))
        store.upsert("periodic_reports", _filled(_made(spark, sf_dir, _REPORTS, "orders").withColumn("ingest_seq", L(1)), "periodic_reports"))
        store.replace("periodic_chunks", chunks, _filled(chunks, "periodic_chunks"), "accession_number")
        store.write("company_tickers", _filled(tickers(spark, sf_dir), "company_tickers"))
    few = embedding.Selection(form_type="13F-HR", filed_from=date(1995, 6, 1), filed_to=date(1999, 12, 31), limit=25)
    for name, chosen, dimension in (("first", few, 4), ("second", replace(few, limit=None), 4), ("first", few, 5)):
        backfill.run_backfill(store, embedding.Profile(name, embedding_dimension=dimension), embedding.HashEmbedder(dimension), chosen)
    return store.read("chunk_embeddings").where(F.size("embedding") == F.when(C("profile_name") == "first", 5).otherwise(4)).select("chunk_key", "profile_name", C("embedding_input_hash").alias("input_hash"))


# ---- sources --------------------------------------------------------------------------------------------------------------


def _joined(lines: Column, by: str) -> Column:
    return F.array_join(lines, by)


def _month_indexes(spark: SparkSession, sf_dir: str, some: Column | bool = True) -> DataFrame:
    """An index file's text a month, of some filings, with lines that are no entries."""
    day = F.when(E("crc32(accession_number) % 2 = 0"), F.date_format("filed_date", "yyyyMMdd")).otherwise(F.date_format("filed_date", "yyyy-MM-dd"))
    line = F.concat_ws("|", "cik", F.concat(L(" "), "company_name"), "form_type", day, F.concat("archive_path", L(" ")))
    months = filings(spark, sf_dir).where(L(some) if some is True else some).groupBy(F.date_trunc("month", "filed_date").alias("month")).agg(F.collect_list(line).alias("lines"))
    return months.select(F.concat(L("Description: index\r\n1|2|3|4|5\r\n--------\r\n"), _joined(C("lines"), "\r\n"), L("\r\nfour|fields|are|few\r\n\r\n")).alias("text"))


@query(f"""WITH f AS ({_FILINGS[1]}) SELECT cik, company_name, form_type, filed_date, accession_number, 'https://x/' || archive_path AS submission_url,
    'https://x/edgar/data/' || cik || '/' || accession_number AS filing_directory_url, 'https://x/edgar/data/' || cik || '/' || accession_number || '/index.json' AS index_url FROM f""")
def index_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-06, SRC-07, SRC-08, SCL-20: indexes of a month are written out, with lines that are no entries, and read back from bytes."""
    texts = _month_indexes(spark, sf_dir).select(index.decoded(C("text").cast("binary")).alias("text"))
    got = index.index_entries(texts, archive="https://x")
    return got.select("cik", "company_name", "form_type", "filed_date", "accession_number", "submission_url", "filing_directory_url", "index_url")


def _streamed(spark: SparkSession, sf_dir: str, folder: str, lots: list[Column | bool], apply) -> None:
    """Index files of entries arrive in `folder`, lot by lot; a stream parses them and goes on where it stopped."""
    for lot in lots:
        _month_indexes(spark, sf_dir, lot).write.mode("append").option("maxRecordsPerFile", 1).text(f"{folder}/in")
        incremental.run_available(incremental.index_stream(spark, f"{folder}/in", "https://x"), apply, f"{folder}/progress")


def _filled(batch: DataFrame, name: str) -> DataFrame:
    """`batch` with the columns of a stored table, null where it has none."""
    schema = batch.sparkSession.createDataFrame([], ddl(name)).schema
    return batch.select(*((C(f.name) if f.name in batch.columns else L(None)).cast(f.dataType).alias(f.name) for f in schema))


@query(f"WITH f AS ({_FILINGS[1]}) SELECT accession_number, cik, company_name, form_type, filed_date FROM f")
def stream_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-01, STR-03: a run has stored half of the filings under wrong names; a stream then brings all of them in two lots, of which the second repeats the first."""
    folder = scratch_path(spark, "stream")
    store = Store(spark, f"{folder}/store")
    store.migrate()
    run = filings(spark, sf_dir).where("crc32(accession_number) % 2 = 0").withColumns({"company_name": L("wrong"), "ingest_seq": L(upsert.clock())})
    store.upsert("filings", _filled(run, "filings"))
    put = incremental.upserting(store, "filings", ["accession_number"])
    _streamed(spark, sf_dir, folder, [C("filed_date") < "1995-01-01", True], lambda batch, number: put(_filled(batch, "filings"), number))
    return store.read("filings").select("accession_number", "cik", "company_name", "form_type", "filed_date")


@query(f"""WITH f AS ({_FILINGS[1]}), m AS (SELECT max(filed_date) - INTERVAL 7 DAY AS bound FROM f WHERE filed_date < DATE '1995-03-05'),
    l AS (SELECT filed_date, filed_date < DATE '1995-03-05' OR filed_date >= bound AS kept, filed_date BETWEEN DATE '1995-02-20' AND DATE '1995-03-04' AND filed_date < bound AS late FROM f, m WHERE filed_date < DATE '1995-03-05' OR filed_date >= DATE '1995-02-20')
    SELECT filed_date, count(*) FILTER (WHERE kept) AS n_kept, count(*) FILTER (WHERE late) AS n_late FROM l GROUP BY filed_date""")
def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-02: a second lot begins before the first one ended; entries up to seven days behind are stored, those further behind counted."""
    folder = scratch_path(spark, "late")
    store = Store(spark, f"{folder}/store")
    store.migrate()
    put = incremental.upserting_until(store, "filings", "late_filings", ["accession_number"], "filed_date", 7)
    _streamed(spark, sf_dir, folder, [C("filed_date") < "1995-03-05", C("filed_date") >= "1995-02-20"], lambda batch, number: put(_filled(batch, "filings"), number))
    kept = store.read("filings").groupBy("filed_date").agg(F.count("*").alias("n_kept"))
    return kept.join(store.read("late_filings"), "filed_date", "full").select("filed_date", F.coalesce("n_kept", L(0)).alias("n_kept"), F.coalesce("n", L(0)).alias("n_late"))


@query(f"WITH {_WORLD} SELECT {', '.join(_HELD)} FROM pos")
def stored_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-02 to SNK-09, SNK-20, STR-04: filings, holdings and names come in two batches, each in one commit over all tables; after the second, which holds late resets, views are refreshed for its filers alone."""
    store = Store(spark, f"{scratch_path(spark, 'filings')}/store")
    store.migrate()
    rows = {"filings": filings(spark, sf_dir), "thirteenf_filings": holders(spark, sf_dir), "thirteenf_holdings": _made(spark, sf_dir, _HOLDINGS, "lineitem")}
    with store.commit():
        store.upsert("security_references", _filled(securities(spark, sf_dir).withColumn("ingest_seq", L(1)), "security_references"))
        store.upsert("filers", _filled(_made(spark, sf_dir, _FILERS, "customer").withColumn("ingest_seq", L(1)), "filers"))
    for step, lot in enumerate(("% 10 <> 3", "% 10 = 3")):
        batch = {n: _filled(df.where(f"CAST(accession_number AS INT) {lot}").withColumn("ingest_seq", L(step)), n) for n, df in rows.items()}
        with store.commit():
            store.upsert("filings", batch["filings"])
            store.upsert("thirteenf_filings", batch["thirteenf_filings"])
            store.replace("thirteenf_holdings", batch["filings"], batch["thirteenf_holdings"], "accession_number")
            refresh_views(store, batch["filings"].select("cik").distinct())
    return store.read("filer_positions").select(*_HELD)


@query(f"""SELECT {_KEY.replace("{s}", "VARCHAR")} AS accession_number, o_orderdate + INTERVAL 1 SECOND * (o_orderkey % 60)::INT AS accepted, CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE 'primary_' || o_orderkey || '.xml' END AS primary_file,
    CASE WHEN o_orderpriority IN ('5-LOW', '4-NOT SPECIFIED') THEN NULL ELSE 'info table.xml' END AS table_file, CASE WHEN o_orderpriority = '5-LOW' THEN 'no XML documents' END AS problem,
    CASE WHEN o_orderkey % 2 = 0 THEN 'b_10k.htm' ELSE 'a_other.html' END AS report_file, CASE WHEN o_orderpriority = '5-LOW' THEN 1 WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 2 ELSE 3 END AS n_data, CASE WHEN o_orderpriority = '5-LOW' THEN 3 WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 4 ELSE 5 END AS n_documents FROM orders""")
def submission_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-09 to SRC-12: envelopes are written out, by tags or by labelled lines, and read back."""
    rows = dealt(table(spark, sf_dir, "orders")).select("o_orderkey", "o_orderpriority", F.lpad(C("o_orderkey").cast("string"), 10, "0").alias("key"), F.date_format(E("o_orderdate + make_interval(0, 0, 0, 0, 0, 0, o_orderkey % 60)"), "yyyyMMddHHmmss").alias("at"), E(_FORM).alias("form"))

    def doc(kind: Column, number: Column, name: Column) -> Column:
        return F.concat(L("<DOCUMENT>\n<TYPE>"), kind, L("\n<SEQUENCE>"), number, L("\n<FILENAME> "), name, L("\n<DESCRIPTION>d\n<TEXT>x</TEXT>\n</DOCUMENT>\n"))

    tagged = F.concat(L("<SEC-HEADER>\n<ACCESSION-NUMBER>"), "key", L("\n<ACCEPTANCE-DATETIME>"), "at", L("\n"))
    labelled = F.concat(L("ACCEPTANCE-DATETIME:  "), "at", L("\nACCESSION NUMBER:\t\t"), "key", L("\n"))
    even, low, notice = C("o_orderkey") % 2 == 0, C("o_orderpriority") == "5-LOW", C("o_orderpriority") == "4-NOT SPECIFIED"
    text = F.concat(
        F.when(C("o_orderkey") % 3 == 0, labelled).otherwise(tagged),
        F.when(low, "").otherwise(doc(C("form"), L("1"), F.concat(L("primary_"), C("o_orderkey").cast("string"), L(".xml")))),
        F.when(low | notice, "").otherwise(doc(L("INFORMATION TABLE"), L("2"), L("info table.xml"))),
        doc(F.when(even, "10-K").otherwise("EX-99"), L("7"), L("b_10k.htm")),
        doc(L("EX-99"), F.when(even, "1").otherwise("3"), L("a_other.html")),
        doc(L("EX-101.INS"), L("9"), L("facts.txt")),
        L("<DOCUMENT>\n<TYPE>10-K\n</DOCUMENT>\n"),  # names no file
    )
    read = rows.select("form", "o_orderkey", text.alias("t")).select("form", submission.header(C("t")).alias("h"), submission.documents(C("t")).alias("d"))
    chosen = read.select("h", "d", submission.holdings_documents(C("form"), C("d")).alias("x"), submission.periodic_documents(L("10-K/A"), C("d")).alias("p"))
    return chosen.select("h.accession_number", C("h.acceptance_datetime").alias("accepted"), C("x.primary.filename").alias("primary_file"), C("x.info_table.filename").alias("table_file"), C("x.error").alias("problem"), C("p.primary.filename").alias("report_file"), F.size("p.xbrl").alias("n_data"), F.size("d").alias("n_documents"))


_LINES = "row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey, l_linenumber, l_suppkey, l_extendedprice, l_quantity, l_shipdate, l_returnflag, l_linestatus, l_discount, l_tax)"
_ISSUER = "CASE WHEN l_partkey % 3 = 0 THEN 'Straße  ' || p_name ELSE p_name || ' & Co' END"


@query(f"""WITH o AS (SELECT *, {_LINES}::INT AS n FROM lineitem JOIN part ON p_partkey = l_partkey),
    x AS (SELECT lpad(l_orderkey::VARCHAR, 10, '0') AS accession_number, n, {_ISSUER} AS issuer, p_type, 'ab' || l_partkey AS cusip, CASE l_returnflag WHEN 'R' THEN 'Put' END AS put_call, l_extendedprice::DECIMAL(20,2) AS v, l_quantity::DECIMAL(20,2) AS q, l_orderkey % 2 = 0 AS late FROM o)
    SELECT accession_number, n AS holding_sequence, issuer AS issuer_name, p_type AS class_title, sha256(lower(trim(regexp_replace(replace(issuer, 'ß', 'ss'), '\\s+', ' ', 'g'))) || '|' || lower(p_type) || '|' || upper(cusip) || '|') AS security_reference_key,
    put_call, v AS value_reported, CASE WHEN late THEN 'USD' ELSE 'THOUSANDS_USD' END AS value_unit, (v * CASE WHEN late THEN 1 ELSE 1000 END)::DECIMAL(20,2) AS value_usd, q AS shares_principal_amount FROM x""")
def holdings_xml_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-13, SCL-09 to SCL-11, SCL-16, SCL-17: information tables are written out as XML, some with prefixes, and parsed."""
    found = holdings_xml.parse_holdings_reports(_holdings_xml(spark, sf_dir)).where("error IS NULL").select("accession_number", F.explode("holdings").alias("h")).select("accession_number", "h.*")
    return found.select(*_LINE)


@query(SQL["holdings_xml_rows"])
def loaded_holdings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PIP-05, SNK-02 to SNK-11: the same tables go through the loader, with a half of the filings written twice, and are read from the store."""
    store = Store(spark, f"{scratch_path(spark, 'loaded')}/store")
    store.migrate()
    key = C("accession_number").cast("int")
    made = _holdings_xml(spark, sf_dir).withColumns({"cik": (key % 40).cast("string"), "company_name": F.concat(L("Company "), (key % 40).cast("string")), "place": key, **{c: L(None).cast("string") for c in ("archive_path", "submission_url", "filing_directory_url", "index_url", "primary_document_filename", "information_table_filename")}, "acceptance_datetime": L(None).cast("timestamp")})
    for some in (L(True), key % 2 == 0):
        with store.commit():
            ingest.load_filings(store, ingest.HOLDINGS, holdings_xml.parse_holdings_reports(made.where(some)), None)
    return store.read("thirteenf_holdings").select(*_LINE)


_SITE, _FIRST_END = "https://x/edgar", date(2021, 6, 30)
#: How filings of the site fare: no XML in the envelope, a primary document that the site lacks, all there.
_FARE = "CASE WHEN o_orderpriority = '5-LOW' THEN 'none' WHEN o_orderkey % 7 = 0 THEN 'lost' ELSE 'good' END"


def _site(spark: SparkSession, sf_dir: str, *suffixes: str) -> list[DataFrame]:
    """An archive as a table of addresses and contents: indexes by quarter, directories of some filings, envelopes, covers and tables of holdings.

    One table for each suffix of the names in the indexes. It is written out, as a mirror is: whatever is asked of it reads it, and builds nothing anew.
    """
    key, filer = _KEY.replace("{s}", "STRING"), _FILER.replace("{s}", "STRING")
    rows = table(spark, sf_dir, "orders").select(E(key).alias("key"), E(f"concat('{_SITE}/data/', {filer}, '/', {key})").alias("place"), E(filer).alias("cik"), E("CAST(o_orderdate AS DATE) + INTERVAL 25 YEAR").cast("date").alias("day"), (C("o_orderpriority") == "4-NOT SPECIFIED").alias("notice"), E(_FARE).alias("fare"), (C("o_orderkey") % 2 == 0).alias("listed"))
    form = F.when(C("notice"), "13F-NT").otherwise("13F-HR")

    def quarters(suffix: str) -> DataFrame:
        line = F.concat_ws("|", "cik", F.concat(L("Company "), "cik", L(suffix)), form, F.date_format("day", "yyyy-MM-dd"), F.concat(L("edgar/data/"), "cik", L("/"), "key", L(".txt")))
        return rows.groupBy(F.concat(L(f"{_SITE}/full-index/"), F.year("day").cast("string"), L("/QTR"), F.quarter("day").cast("string"), L("/master.idx")).alias("url")).agg(F.concat(L("top\n----\n"), _joined(F.collect_list(line), "\n")).alias("content"))

    def doc(kind: Column, name: str) -> Column:
        return F.concat(L("<DOCUMENT>\n<TYPE>"), kind, L(f"\n<SEQUENCE>1\n<FILENAME>{name}\n</DOCUMENT>\n"))

    none = C("fare") == "none"
    envelope = F.concat(L("<ACCESSION-NUMBER>"), "key", L("\n<ACCEPTANCE-DATETIME>"), F.date_format("day", "yyyyMMdd"), L("101112\n"), F.when(none, doc(form, "note.htm")).otherwise(doc(form, "cover.xml")), F.when(none | C("notice"), "").otherwise(doc(L("INFORMATION TABLE"), "table.xml")))
    cover = F.concat(L("<edgarSubmission><headerData><filerInfo><periodOfReport>"), F.date_format("day", "MM-dd-yyyy"), L("</periodOfReport></filerInfo></headerData><formData><coverPage><isAmendment>false</isAmendment></coverPage></formData></edgarSubmission>"))
    parts = [rows.where("listed").select(F.concat("place", L("/index.json")).alias("url"), L("{}").alias("content")), rows.select(F.concat("place", L(".txt")).alias("url"), envelope.alias("content")), rows.where("fare = 'good'").select(F.concat("place", L("/cover.xml")).alias("url"), cover.alias("content"))]
    tables = _holdings_xml(spark, sf_dir).join(rows.where("fare != 'none' AND NOT notice").select("key", "place"), C("accession_number") == C("key")).select(F.concat("place", L("/table.xml")).alias("url"), C("info_xml").alias("content"))
    for part in parts:
        tables = tables.unionByName(part)
    filed, *indexes = (staged(df.select("url", C("content").cast("binary").alias("content"))) for df in (tables, *map(quarters, suffixes)))
    return [filed.unionByName(index) for index in indexes]


@query(f"""WITH o AS (SELECT *, {_KEY.replace("{s}", "VARCHAR")} AS k, {_FILER.replace("{s}", "VARCHAR")} AS cik, (o_orderdate::DATE + INTERVAL 25 YEAR)::DATE AS day, {_FARE} AS fare, o_orderpriority = '4-NOT SPECIFIED' AS notice FROM orders),
    l AS (SELECT l_orderkey, count(*) AS n, sum(l_extendedprice::DECIMAL(20,2)) AS v FROM lineitem GROUP BY l_orderkey),
    w AS (SELECT o.*, n, v, CASE WHEN fare = 'none' THEN 'ValueError: no XML documents' WHEN fare = 'lost' THEN 'NotFound: {_SITE}/data/' || cik || '/' || k || '/cover.xml' WHEN NOT notice AND n IS NULL THEN 'NotFound: {_SITE}/data/' || cik || '/' || k || '/table.xml' END AS error FROM o LEFT JOIN l ON l_orderkey = o_orderkey),
    c AS (SELECT max((day, k)) AS upto FROM w WHERE error IS NULL AND day <= DATE '{_FIRST_END}')
    SELECT k AS accession_number, CASE WHEN error IS NULL THEN 'SUCCESS' ELSE 'FAILED' END AS status, error, CASE WHEN error IS NULL THEN 'Company ' || cik || CASE WHEN (day, k) <= (SELECT upto FROM c) THEN '' ELSE ' II' END END AS company_name,
    CASE WHEN error IS NULL THEN day END AS report_period, CASE WHEN error IS NULL THEN day + INTERVAL 36672 SECOND END AS accepted, CASE WHEN error IS NULL THEN CASE WHEN notice THEN 0 ELSE n END END AS n_holdings,
    CASE WHEN error IS NULL AND NOT notice THEN (v * CASE WHEN day < DATE '2023-01-03' THEN 1000 ELSE 1 END)::DECIMAL(38,2) END AS value_usd, CASE WHEN error IS NULL THEN 2 + (NOT notice)::INT + (o_orderkey % 2 = 0)::INT END AS n_artifacts FROM w""")
def ingested_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PIP-01 to PIP-07, SRC-04, SRC-05, SRC-15, SNK-01, SNK-11, SNK-12, SET-03, SCL-30: a full run over an archive up to a day, a second one that goes on from its checkpoint while the index has other names, then everything parsed again from what was cached."""
    folder = scratch_path(spark, "ingested")
    store = Store(spark, f"{folder}/store")
    store.migrate()
    for end, site in zip((_FIRST_END, date(2030, 12, 31)), _site(spark, sf_dir, "", " II"), strict=True):
        ingest.run_ingest(spark, store, acquire.mirror(site), folder, ingest.Options(mode="full", start=date(2016, 1, 1), end=end, refresh=False), archive="https://x")
    ingest.run_reprocess(spark, store, folder, ingest.HOLDINGS, refresh=False)
    one = ["accession_number"]
    lines = store.read("thirteenf_holdings").groupBy(*one).agg(F.count("*").alias("n"), F.sum("value_usd").cast("decimal(38,2)").alias("value_usd"))
    kept = store.read("filing_artifacts").groupBy(*one).agg(F.count("*").alias("n_artifacts"))
    found = store.read("filings").select(*one, "company_name", C("period_of_report").alias("report_period"), C("acceptance_datetime").alias("accepted"))
    state = store.read("filing_processing").select(*one, "status", "error")
    joined = state.join(found, one, "left").join(lines, one, "left").join(kept, one, "left")
    return joined.select(*one, "status", "error", "company_name", "report_period", "accepted", F.when(C("company_name").isNotNull(), F.coalesce("n", L(0))).alias("n_holdings"), "value_usd", "n_artifacts")


_LINE = ["accession_number", "holding_sequence", "issuer_name", "class_title", "security_reference_key", "put_call", "value_reported", "value_unit", "value_usd", "shares_principal_amount"]


def _holdings_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filings with cover page and information table as XML, one for each order."""
    lines = spark.sql(f"SELECT *, {_LINES} AS n, {_ISSUER} AS issuer FROM {{l}} JOIN {{p}} ON p_partkey = l_partkey", l=table(spark, sf_dir, "lineitem"), p=table(spark, sf_dir, "part"))
    tag = lambda name, value: F.concat(L(f"<@{name}>"), value, L(f"</@{name}>"))
    one = tag("infoTable", F.concat(tag("nameOfIssuer", F.replace("issuer", L("&"), L("&amp;"))), tag("titleOfClass", F.concat(L(" "), "p_type", L("\n"))), tag("cusip", F.concat(L("ab"), C("l_partkey").cast("string"))), tag("value", C("l_extendedprice").cast("decimal(20,2)").cast("string")),
        tag("shrsOrPrnAmt", F.concat(tag("sshPrnamt", C("l_quantity").cast("decimal(20,2)").cast("string")), tag("sshPrnamtType", L("SH")))), F.when(C("l_returnflag") == "R", tag("putCall", L("Put"))).otherwise("")))
    tables = lines.groupBy("l_orderkey").agg(_joined(F.transform(F.array_sort(F.collect_list(F.struct("n", one.alias("x")))), lambda r: r.x), "").alias("body"))
    late = C("l_orderkey") % 2 == 0
    info = F.when(late, F.concat(L('<ns1:informationTable xmlns:ns1="urn:a">'), F.replace("body", L("@"), L("ns1:")), L("</ns1:informationTable>"))).otherwise(F.concat(L('<informationTable xmlns="urn:a">'), F.replace("body", L("@"), L("")), L("</informationTable>")))
    cover = L("<edgarSubmission><headerData><filerInfo><periodOfReport>12-31-2022</periodOfReport></filerInfo></headerData><formData><coverPage><isAmendment>false</isAmendment></coverPage></formData></edgarSubmission>")
    return dealt(tables, table(spark, sf_dir, "orders").count()).select(F.lpad(C("l_orderkey").cast("string"), 10, "0").alias("accession_number"), L("13F-HR").alias("form_type"), F.when(late, E("DATE '2023-01-03'")).otherwise(E("DATE '2023-01-02'")).alias("filed_date"), cover.alias("primary_xml"), info.alias("info_xml"))


@query("""SELECT lpad(o_orderkey::VARCHAR, 10, '0') AS accession_number, CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderdate::DATE END AS report_period, o_orderpriority = '4-NOT SPECIFIED' AS is_notice, o_orderpriority IN ('2-HIGH', '3-MEDIUM') AS is_amendment,
    CASE o_orderpriority WHEN '2-HIGH' THEN 'RESTATEMENT' WHEN '3-MEDIUM' THEN 'UNKNOWN_AMENDMENT_TYPE' END AS amendment_type_code, CASE WHEN o_orderkey % 4 = 0 THEN 'Fallback Filer' ELSE 'Manager ' || o_custkey END AS filing_manager_name,
    CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_totalprice::DECIMAL(20,2) END AS table_value_total_reported, o_orderkey % 3 = 0 AS is_confidential_omitted,
    CASE WHEN o_orderkey % 13 = 0 THEN 'invalid table_value_total' WHEN o_orderkey % 11 = 0 THEN 'period_of_report is missing or not a date' END AS problem FROM orders""")
def cover_page_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-13, SCL-12 to SCL-17: cover pages are written out with all forms of dates and booleans, and parsed; malformed values are errors."""
    key = C("o_orderkey")
    forms = [F.date_format("o_orderdate", f) for f in ("yyyy-MM-dd", "MM-dd-yyyy", "MM/dd/yyyy", "yyyyMMdd")]
    day = F.when(key % 11 == 0, "soon").otherwise(F.element_at(F.array(*forms), (key % 4 + 1).cast("int")))
    tag = lambda name, value: F.concat(L(f"<{name}>"), value, L(f"</{name}>"))
    kind = F.when(C("o_orderpriority") == "2-HIGH", " Restatement ").otherwise("corrected")
    omitted = F.element_at(F.array(*map(L, ("true", "N", "0", "Y", "no", "False"))), (key % 6 + 1).cast("int"))
    cover = F.concat(tag("isAmendment", F.when(C("o_orderpriority") == "3-MEDIUM", "yes").otherwise("0")), tag("amendmentType", kind), tag("filingManager", tag("name", F.when(key % 4 == 0, "  ").otherwise(F.concat(L("Manager "), C("o_custkey").cast("string"))))))
    summary = F.concat(tag("tableValueTotal", F.when(key % 13 == 0, "1,000").otherwise(C("o_totalprice").cast("decimal(20,2)").cast("string"))), tag("isConfidentialOmitted", omitted))
    filer = F.concat(tag("periodOfReport", day), tag("filer", tag("name", L("Fallback Filer"))))
    xml = tag("edgarSubmission", F.concat(tag("headerData", tag("filerInfo", filer)), tag("formData", F.concat(tag("coverPage", cover), tag("summaryPage", summary)))))
    form = F.when(C("o_orderpriority") == "4-NOT SPECIFIED", "13F-NT").when(C("o_orderpriority") == "2-HIGH", "13F-HR/A").otherwise("13F-HR")
    made = dealt(table(spark, sf_dir, "orders")).select(F.lpad(key.cast("string"), 10, "0").alias("accession_number"), form.alias("form_type"), E("DATE '2024-01-01'").alias("filed_date"), xml.alias("primary_xml"), L(None).cast("string").alias("info_xml"))
    return holdings_xml.parse_holdings_reports(made).select("accession_number", "report_period", "is_notice", "is_amendment", "amendment_type_code", "filing_manager_name", "table_value_total_reported", "is_confidential_omitted", C("error").alias("problem"))


def _report_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Annual reports with a table of contents, two sections, hidden scripts and inline facts."""
    key, text = C("o_orderkey").cast("string"), C("o_orderpriority")
    amount = F.when(C("o_orderkey") % 3 == 0, F.concat(L("("), F.format_number(C("o_totalprice").cast("decimal(20,2)"), 2), L(")"))).otherwise(F.concat(L("$ "), F.format_number(C("o_totalprice").cast("decimal(20,2)"), 2)))
    html = F.concat(
        L("<html><head><title>Report "), key, L("</title><style>p {}</style></head><body><p>Item 1. Business</p><p>Item 1A: Risk Factors</p><script>Item 1 Business</script>"),
        L('<xbrli:context id="c1"><xbrli:entity><xbrli:segment><xbrldi:explicitMember dimension="d:B">m2</xbrldi:explicitMember><xbrldi:explicitMember dimension="d:A">m1</xbrldi:explicitMember></xbrli:segment></xbrli:entity><xbrli:period><xbrli:startDate>2020-01-01</xbrli:startDate><xbrli:endDate>'), F.date_format("o_orderdate", "yyyy-MM-dd"), L("</xbrli:endDate></xbrli:period></xbrli:context>"),
        L('<p>ITEM&nbsp;1 - BUSINESS</p><p>We sell '), text, L('.</p><p>Worth <ix:nonFraction name="us-gaap:Assets" contextRef="c1" unitRef="usd" decimals="-3" scale="3">'), amount, L("</ix:nonFraction></p>"),
        L('<p>item 1a. risk   factors</p><p>None of <ix:nonNumeric name="DocumentPeriodEndDate" contextRef="c2">'), F.date_format("o_orderdate", "yyyy-MM-dd"), L("</ix:nonNumeric></p></body></html>"),
    )
    return dealt(table(spark, sf_dir, "orders")).select(F.lpad(key, 10, "0").alias("accession_number"), L("10-K").alias("form_type"), E("DATE '2024-01-01'").alias("filed_date"), html.cast("binary").alias("html"))


_AMOUNT = "replace(format('{:,.2f}', o_totalprice), ' ', '')"


@query(f"""SELECT lpad(o_orderkey::VARCHAR, 10, '0') AS accession_number, 'us-gaap:Assets' AS concept, 'us-gaap' AS namespace_prefix, 'Assets' AS local_name, CASE WHEN o_orderkey % 3 = 0 THEN '(' || {_AMOUNT} || ')' ELSE '$ ' || {_AMOUNT} END AS raw_value,
    (o_totalprice::DECIMAL(20,2) * CASE WHEN o_orderkey % 3 = 0 THEN -1000 ELSE 1000 END)::DECIMAL(38,2) AS numeric_value, NULL::VARCHAR AS fact_value, DATE '2020-01-01' AS period_start, o_orderdate::DATE AS period_end, '{{"d:A": "m1", "d:B": "m2"}}' AS dimensions_json FROM orders
    UNION ALL SELECT lpad(o_orderkey::VARCHAR, 10, '0'), 'DocumentPeriodEndDate', NULL, 'DocumentPeriodEndDate', strftime(o_orderdate, '%Y-%m-%d'), NULL, strftime(o_orderdate, '%Y-%m-%d'), NULL, NULL, '{{}}' FROM orders""")
def report_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-14, TXT-06, TXT-07, TXT-08, JON-14, SCL-18, SCL-19."""
    found = reports.parse_reports(_report_html(spark, sf_dir), parts=["facts"]).where("error IS NULL").select("accession_number", F.explode("facts").alias("f")).select("accession_number", "f.*")
    return found.select("accession_number", "concept", "namespace_prefix", "local_name", "raw_value", C("numeric_value").cast("decimal(38,2)").alias("numeric_value"), "fact_value", "period_start", "period_end", "dimensions_json")


@query("""WITH b AS (SELECT *, 'Report ' || o_orderkey || chr(10) || 'Item 1. Business' || chr(10) || 'Item 1A: Risk Factors' || chr(10) || 'm2' || chr(10) || 'm1' || chr(10) || '2020-01-01' || chr(10) || strftime(o_orderdate, '%Y-%m-%d') || chr(10) AS before,
        'ITEM 1 - BUSINESS' || chr(10) || 'We sell' || ' ' || o_orderpriority || '.' AS x FROM orders)
    SELECT lpad(o_orderkey::VARCHAR, 10, '0') AS accession_number, k AS section_key, l AS item_label, t AS section_title, o_orderdate::DATE AS report_period, 'Report ' || o_orderkey AS title, 2 AS n_sections FROM b, (VALUES ('business', 'Item 1', 'Business'), ('risk_factors', 'Item 1A', 'Risk Factors')) v(k, l, t)""")
def report_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-14, TXT-01 to TXT-04, AGG-08, SCL-22: sections begin at the last heading of each item."""
    found = reports.parse_reports(_report_html(spark, sf_dir), parts=["sections"]).where("error IS NULL")
    return found.select("accession_number", F.explode("sections").alias("s"), "report_period", C("primary_document_title").alias("title"), F.size("sections").alias("n_sections")).select("accession_number", "s.section_key", "s.item_label", "s.section_title", "report_period", "title", "n_sections")


@query("""SELECT lpad(o_orderkey::VARCHAR, 10, '0') AS accession_number, 'item 1a. risk factors None of ' || strftime(o_orderdate, '%Y-%m-%d') AS words, 'ITEM 1 - BUSINESS We sell ' || o_orderpriority || '. Worth' AS first_words FROM orders""")
def report_section_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TXT-01, TXT-03: visible text of the sections, without scripts and tables of contents."""
    found = reports.parse_reports(_report_html(spark, sf_dir), parts=["sections"]).where("error IS NULL").select("accession_number", *(F.regexp_replace(F.get("sections", L(i)).text_content, r"\s+", " ").alias(n) for i, n in enumerate(("a", "words"))))
    return found.select("accession_number", "words", F.regexp_extract("a", "^(.*? Worth)", 1).alias("first_words"))


# ---- scalar forms, states, order ------------------------------------------------------------------------------------------


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 6 THEN NULL ELSE o_orderdate::DATE END AS day, CASE o_orderkey % 4 WHEN 0 THEN true WHEN 1 THEN false END AS flag, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_totalprice::DECIMAL(20,2) END AS amount,
    CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority ELSE 'x' END AS present, CASE WHEN o_orderkey % 2 = 0 THEN 'us-gaap' END AS prefix, 'N' || o_orderkey AS local FROM orders""")
def lenient_scalars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SCL-13 to SCL-17, SCL-19: all forms, and null for what is none of them."""
    key = C("o_orderkey")
    dates = [F.date_format("o_orderdate", f) for f in ("yyyy-MM-dd", "MM-dd-yyyy", " MM/dd/yyyy", "yyyyMMdd ", "yyyy-MM-dd", "MM/dd/yyyy")] + [F.date_format("o_orderdate", "dd.MM.yyyy")]
    flags = [F.when(key % 8 < 4, a).otherwise(b) for a, b in (("TRUE", " yes"), ("0", "N"), ("maybe", ""), ("2", "tru"))]
    amount = F.when(key % 5 == 0, F.format_number(C("o_totalprice") + 1000, 2)).otherwise(F.concat(L(" "), C("o_totalprice").cast("decimal(20,2)").cast("string")))
    prefix, local = N.split_concept(F.when(key % 2 == 0, F.concat(L("us-gaap:N"), key.cast("string"))).otherwise(F.concat(L("N"), key.cast("string"))))
    pick = lambda xs: F.element_at(F.array(*xs), (key % len(xs) + 1).cast("int"))
    return table(spark, sf_dir, "orders").select("o_orderkey", N.parsed_date(pick(dates)).alias("day"), N.parsed_bool(pick(flags)).alias("flag"), N.parsed_decimal(amount).alias("amount"), N.first_present(L(" \t"), F.when(key % 3 == 0, C("o_orderpriority")), L(" x ")).alias("present"), prefix.alias("prefix"), local.alias("local"))


@query("""SELECT user_id, arg_max(event_type, event_id) AS status, arg_max(coalesce(value::VARCHAR, '?'), event_id) AS error, max(CASE WHEN event_type = 'click' THEN ts END) AS started_at, CASE WHEN arg_max(event_type, event_id) <> 'click' THEN arg_max(ts, event_id) END AS finished_at FROM events GROUP BY user_id""")
def processing_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-10: `processing_state` over a log; a click plays the start of a run."""
    running = F.when(C("event_type") == "click", "RUNNING").otherwise(C("event_type"))
    rows = table(spark, sf_dir, "events").select("user_id", running.alias("status"), F.coalesce(C("value").cast("string"), L("?")).alias("error"), C("ts").alias("at"), C("event_id").alias("ingest_seq"))
    got = upsert.processing_state(rows, ["user_id"])
    return got.withColumn("status", F.when(C("status") == "RUNNING", "click").otherwise(C("status")))


@query(f"WITH f AS ({_FILINGS[1]}) SELECT accession_number, filed_date FROM f WHERE filing_family = '13F' AND filed_date BETWEEN DATE '1996-01-01' AND DATE '1997-06-30' ORDER BY filed_date, accession_number LIMIT 50")
def reprocess_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-16, FLT-04, SRT-08: stored filings of a family in order, the first fifty."""
    chosen = artifacts.filings_to_reprocess(filings(spark, sf_dir), "13F", None, date(1996, 1, 1), date(1997, 6, 30))
    return index.in_order(chosen, 50).select("accession_number", "filed_date")
