"""Every binding against its SQL, on the smallest tables."""

import duckdb
import pytest

from ledgerloom import filing_queries, queries as Q

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def plain(rows):
    return sorted(tuple(repr(float(x)) if isinstance(x, float) else str(x) for x in r) for r in rows)


@pytest.mark.parametrize("name", sorted(Q.QUERIES))
def test_against_sql(spark, sf_dir, db, name):
    df = Q.QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = df.select(*columns).collect()
    if name in Q.SQL:
        want = db.sql(Q.SQL[name])
        assert columns == sorted(want.columns)
        assert plain(got) == plain(want.project(", ".join(f'"{c}"' for c in columns)).fetchall())


def test_entry_point():
    import __spark_entry__ as entry

    assert set(Q.QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_filters_reach_the_scan(spark, sf_dir):
    plan = Q.year_positions(spark, sf_dir, 1998)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(l_shipdate" in plan and "l_tax" not in plan


def test_the_filer_reaches_the_scan(spark, sf_dir):
    spark.conf.set("spark.sql.maxMetadataStringLength", 1000)
    try:
        plan = Q.year_positions(spark, sf_dir, 1998, 5)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "EqualTo(l_suppkey,5)" in plan


def test_reports_hand_back_only_what_a_query_reads(spark, sf_dir):
    for query, part in ((filing_queries.report_facts, "facts"), (filing_queries.report_sections, "sections"), (filing_queries.report_section_texts, "sections")):
        plan = query(spark, sf_dir)._jdf.queryExecution().analyzed().toString()
        found = next(line for line in plan.splitlines() if "MapInArrow" in line)
        assert {p for p in ("sections#", "chunks#", "facts#") if p in found} == {f"{part}#"}


def test_compare_from_sql(spark, sf_dir):
    """The table function gives what the operator gives, without and with filters."""
    from ledgerloom.operators import compare, events
    from ledgerloom.plans.refresh import register_compare

    held = filing_queries.held(spark, sf_dir).cache()
    effective = events.effective_filings(filing_queries.filings(spark, sf_dir), filing_queries.holders(spark, sf_dir)).cache()
    held.createOrReplaceTempView("filer_positions")
    effective.createOrReplaceTempView("effective_filings")
    register_compare(spark)
    now, then = [r.report_period for r in held.where("cik = '5'").select("report_period").distinct().orderBy("report_period").limit(2).collect()][::-1]
    for which, put_call in (("all", None), ("options_only", "put")):
        got = spark.sql(f"SELECT * FROM compare_positions('5', DATE '{now}', DATE '{then}', '{which}', {'NULL' if put_call is None else repr(put_call)})")
        want = compare.compare_filer(held, effective, "5", str(now), str(then), which, put_call)
        assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))
    held.unpersist()
    effective.unpersist()


def test_the_table_function_reads_positions_once(spark, sf_dir):
    plan = Q.compare_from_sql(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("l_shipdate#") and sum("Relation [l_orderkey" in line for line in plan.splitlines()) <= 4  # two periods of the positions, and of the filings that name them


def _odd(spark, tmp_path, table, rows, name):
    """A binding on a table of `rows` and its SQL on the same."""
    rows.write.parquet(f"{tmp_path}/{table}.parquet")
    connection = duckdb.connect()
    connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{tmp_path}/{table}.parquet/*.parquet'")
    df = Q.QUERIES[name](spark, str(tmp_path))
    want = connection.sql(Q.SQL[name])
    return plain(df.collect()), plain(want.project(", ".join(f'"{c}"' for c in df.columns)).fetchall())


_PAGES = ["<title>a&quot;b &amp</title><p>x &amp y&amp;lt;</p>", "<title>&amp;gt; &nbsp;c&#65;</title><p>&copy;&middot;&eacute;&quot;</p>", "<p>no\xa0break\r\n \f here</p>", "<title> </title>", "", None]


@pytest.mark.parametrize("name", ["html_text", "html_title"])
def test_odd_pages(spark, tmp_path, name):
    """Character references that the SQL does not name, or that lack their semicolon, stay as they are."""
    rows = spark.createDataFrame(list(enumerate(_PAGES)), "page_id long, html string")
    got, want = _odd(spark, tmp_path, "pages", rows, name)
    assert got == want


def test_halves_of_floats(spark, tmp_path):
    """0.3195 as a float, times a thousand, is the float 319.5; as a double it is less."""
    rows = spark.createDataFrame([(0, [0.3195, -0.3195, 0.0005, -0.0004, 1.5]), (1, []), (2, None), (3, [None, 2.0])], "vec_id long, embedding array<float>")
    got, want = _odd(spark, tmp_path, "embeddings", rows, "vector_literal")
    assert got == want
