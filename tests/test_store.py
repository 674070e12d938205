"""One commit over several tables, parts, refused writers, views refreshed for some filers, streams over an ingested store."""

import os
import random
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators.embedding import Profile
from ledgerloom.operators.upsert import clock
from ledgerloom.plans.backfill import set_profile
from ledgerloom.plans.refresh import VIEWS, holders_of_renamed, refresh_views
from ledgerloom.plans.store import Conflict, Store
from ledgerloom.schemas import ddl
from ledgerloom.streaming.incremental import run_available, upserting, upserting_until


@pytest.fixture
def store(spark, tmp_path):
    made = Store(spark, str(tmp_path / "store"), parts=8)
    made.migrate()
    return made


def rows_of(store, table, columns):
    return sorted(tuple(r) for r in store.read(table).select(*columns).collect())


def frame(spark, table, rows):
    """Rows of a table from some of its columns; the rest is null."""
    schema = spark.createDataFrame([], ddl(table)).schema
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema) for r in rows], schema)


def files(store):
    return {str(p.relative_to(store.root)): p.stat().st_mtime_ns for p in Path(store.root).rglob("*.parquet")}


def filer(n, name="A", seq=1):
    return {"cik": str(n), "filer_name": name, "ingest_seq": seq}


def test_a_commit_is_all_or_nothing(spark, store):
    store.upsert("filers", frame(spark, "filers", [filer(1)]))
    before = files(store)
    with pytest.raises(ZeroDivisionError), store.commit():
        store.upsert("filers", frame(spark, "filers", [filer(1, "B", 2), filer(2)]))
        assert rows_of(store, "filers", ["cik", "filer_name"]) == [("1", "B"), ("2", "A")]  # the writer sees its own
        store.write("company_tickers", spark.createDataFrame([("1", "x", "X")], ddl("company_tickers")))
        assert Store(spark, store.root).read("filers").count() == 1  # others do not
        1 / 0
    assert rows_of(store, "filers", ["cik", "filer_name"]) == [("1", "A")] and store.read("company_tickers").count() == 0
    assert files(store) == before
    with store.commit():
        store.upsert("filers", frame(spark, "filers", [filer(1, "B", 2)]))
        store.write("company_tickers", spark.createDataFrame([("1", "x", "X")], ddl("company_tickers")))
    other = Store(spark, store.root)
    assert rows_of(other, "filers", ["filer_name"]) == [("B",)] and other.read("company_tickers").count() == 1


def test_a_large_update_goes_in_lots(spark, store, monkeypatch):
    """All rows of a table and of a batch lay on disk twice as shuffle files; a lot's alone do now, and the result is the same."""
    monkeypatch.setattr("ledgerloom.plans.store.LOT", 100)
    sent, written = [], store._written
    monkeypatch.setattr(store, "_written", lambda table, df: sent.append((table, df.count())) or written(table, df))

    def lines(filings, seq):
        return frame(spark, "thirteenf_holdings", [{"accession_number": str(n), "holding_sequence": i, "issuer_name": str(seq)} for n in filings for i in range(3)])

    def parents(filings, seq=1):
        return frame(spark, "filings", [{"accession_number": str(n), "cik": str(seq), "ingest_seq": seq} for n in filings])

    with store.commit():
        store.upsert("filings", parents(range(200)), size=200)
        store.replace("thirteenf_holdings", parents(range(200)), lines(range(200), 1), "accession_number", size=600)
    sizes = {t: [n for table, n in sent if table == t] for t in ("filings", "thirteenf_holdings")}
    assert [len(sizes[t]) for t in sizes] == [2, 6] and [sum(sizes[t]) for t in sizes] == [200, 600]
    sent.clear()
    with store.commit():
        store.upsert("filings", parents(range(100, 300), 2), keys=parents(range(100, 300)).select("accession_number"), size=200)
        store.replace("thirteenf_holdings", parents(range(100, 300), 2), lines(range(50, 250), 2).where("accession_number >= 100"), "accession_number", size=450)
    assert len(sent) == 4 + 8  # no more lots than parts
    assert rows_of(store, "filings", ["accession_number", "cik"]) == sorted((str(n), "1" if n < 100 else "2") for n in range(300))
    assert rows_of(store, "thirteenf_holdings", ["accession_number", "holding_sequence", "issuer_name"]) == sorted((str(n), i, "1" if n < 100 else "2") for n in range(250) for i in range(3))
    some = parents(range(300)).where(store._part_of("filings", 8).isin("1", "5"))
    with pytest.raises(ValueError, match="beside those of the keys"):  # no row is dropped because its part is in no lot
        store.replace("thirteenf_holdings", some, lines(range(300), 3), "accession_number", size=900)


def test_a_killed_writer_leaves_the_old_state(spark, store):
    """Files of a writer that never came to its commit are not read, and are removed when old."""
    store.upsert("filers", frame(spark, "filers", [filer(1)]))
    dead = Store(spark, store.root)
    dead._open = dead.manifest()
    dead.upsert("filers", frame(spark, "filers", [filer(1, "lost", 9)]))
    assert rows_of(store, "filers", ["filer_name"]) == [("A",)]
    count = len(files(store))
    assert store.vacuum() == [] and len(files(store)) == count
    assert len(store.vacuum(days=-1)) == 1 and len(files(store)) < count
    assert rows_of(store, "filers", ["filer_name"]) == [("A",)]


def test_a_second_writer_is_refused(spark, store):
    first, second = Store(spark, store.root), Store(spark, store.root)
    with pytest.raises(Conflict), first.commit():
        first.upsert("filers", frame(spark, "filers", [filer(1, "first")]))
        second.upsert("filers", frame(spark, "filers", [filer(2, "second")]))
    assert rows_of(store, "filers", ["cik", "filer_name"]) == [("2", "second")]
    first.upsert("filers", frame(spark, "filers", [filer(1, "again")]))
    assert rows_of(store, "filers", ["cik", "filer_name"]) == [("1", "again"), ("2", "second")]
    with first.commit(("m", 3)) as new:
        assert new
    with second.commit(("m", 3)) as new:
        assert not new
    with pytest.raises(RuntimeError), first.commit(), first.commit():
        pass


def test_an_update_touches_the_parts_of_its_keys(spark, tmp_path):
    store = Store(spark, str(tmp_path / "many"), parts=64)
    store.migrate()
    store.upsert("filings", frame(spark, "filings", [{"accession_number": f"{i:010d}", "company_name": "A", "ingest_seq": 1} for i in range(3000)]))
    before = store.manifest()["tables"]["filings"]["folders"]
    assert len(before) == 64
    seen = files(store)
    touched = store.upsert("filings", frame(spark, "filings", [{"accession_number": f"{i:010d}", "company_name": "B", "ingest_seq": 2} for i in range(10)]))
    after = store.manifest()["tables"]["filings"]["folders"]
    assert len(touched) <= 10 and {p for p in before if after[p] != before[p]} == set(touched)
    assert all(files(store)[f] == at for f, at in seen.items())
    assert store.read("filings").where("company_name = 'B'").count() == 10 and store.read("filings").count() == 3000
    one = store.read("filings", spark.createDataFrame([("0000000003",)], "accession_number string"))
    assert one.count() < 200 and one.where("accession_number = '0000000003'").count() == 1
    kids = spark.createDataFrame([("0000000003", i) for i in range(4)], "accession_number string, manager_ordinal int")
    full = frame(spark, "thirteenf_other_managers", [r.asDict() for r in kids.collect()])
    for some, n in ((full, 4), (full.limit(1), 1)):
        store.replace("thirteenf_other_managers", kids.limit(1), some, "accession_number")
        assert store.read("thirteenf_other_managers").count() == n
    with pytest.raises(ValueError):
        store.update("filings", frame(spark, "filings", [{"accession_number": "1"}]), lambda now: frame(spark, "filings", [{"accession_number": f"{i}"} for i in range(50)]))


def test_old_files_go_two_commits_later(spark, store):
    for i in range(4):
        store.upsert("filers", frame(spark, "filers", [filer(1, f"n{i}", i)]))
    assert len(list(Path(store.root, "manifests").glob("manifest-*"))) == 2
    assert len({os.path.dirname(f) for f in files(store) if f.startswith("filers/")}) == 2


def test_a_changed_profile_leaves_other_profiles_files(spark, store):
    a, b = Profile("a", embedding_dimension=2), Profile("b", embedding_dimension=2)
    for p in (a, b):
        set_profile(store, p, 1)
    vectors = [{"chunk_key": f"k{i}", "profile_name": p, "embedding": [1.0, float(i)], "ingest_seq": 1} for i in range(40) for p in "ab"]
    store.upsert("chunk_embeddings", frame(spark, "chunk_embeddings", vectors))
    before = {f: t for f, t in files(store).items() if f.startswith("chunk_embeddings")}
    set_profile(store, b, 2)
    assert store.read("chunk_embeddings").count() == 80
    set_profile(store, Profile("b", model="other", embedding_dimension=2), 3)
    assert {r.profile_name for r in store.read("chunk_embeddings").collect()} == {"a"}
    now = files(store)
    assert all(now[f] == t for f, t in before.items() if "_part=a." in f)
    assert {r.profile_name: r.model for r in store.read("embedding_profiles").collect()} == {"a": "", "b": "other"}


FORMS = [("13F-HR", False, None), ("13F-HR/A", False, "RESTATEMENT"), ("13F-HR/A", False, "NEW HOLDINGS"), ("13F-NT", True, None)]


def batch_of(spark, draw, numbers, seq):
    """Filings of a few filers and periods with their holdings; later batches hold earlier dates too, and rename securities."""
    filings, thirteenf, holdings, filers, names = [], [], [], {}, {}
    for n in numbers:
        cik, (form, notice, code) = str(draw.randrange(12)), draw.choice(FORMS)
        key = f"{n:010d}"
        filings.append({"accession_number": key, "filing_family": "13F", "cik": cik, "company_name": f"C{cik}", "form_type": form, "filed_date": date(2024, 1, 1 + draw.randrange(28)), "acceptance_datetime": draw.choice([None, datetime(2024, 1, 1 + draw.randrange(28), 9)]), "ingest_seq": seq})
        thirteenf.append({"accession_number": key, "report_period": date(2023, draw.choice([3, 6, 9, 12]), 30), "is_notice": notice, "amendment_type_code": code, "filing_manager_name": f"M{draw.randrange(2)}", "ingest_seq": seq})
        filers[cik] = {"cik": cik, "filer_name": draw.choice(["", f"F{cik}", f"G{cik}"]), "ingest_seq": seq}
        for line in range(draw.randrange(4) if not notice else 0):
            security = f"s{draw.randrange(15)}"
            names[security] = {"security_reference_key": security, "issuer_name": f"{security} {draw.randrange(3)}", "ingest_seq": seq}
            holdings.append({"accession_number": key, "holding_sequence": line, "security_reference_key": security, "value_usd": Decimal(draw.randrange(100)), "shares_principal_amount": Decimal(draw.randrange(9))})
    return {t: frame(spark, t, r) for t, r in (("filings", filings), ("thirteenf_filings", thirteenf), ("filers", list(filers.values())), ("security_references", list(names.values())))}, frame(spark, "thirteenf_holdings", holdings)


def test_views_of_some_filers_equal_a_full_refresh(spark, tmp_path):
    """Random batches with late resets, notices, renamed filers and securities, refiled accessions under another filer."""
    draw, store = random.Random(11), Store(spark, str(tmp_path / "views"), parts=32)
    store.migrate()
    refresh_views(store)
    for step, numbers in enumerate([range(60), [*range(60, 64)], [2, 61, 90, 91]]):
        rows, holdings = batch_of(spark, draw, numbers, step + 1)
        with store.commit():
            keys = rows["filings"].select("accession_number")
            stale = rows["filings"].select("cik").unionByName(store.read("filings", keys).join(keys, "accession_number", "left_semi").select("cik")).unionByName(holders_of_renamed(store, rows["security_references"])).distinct()
            some = spark.createDataFrame(stale.collect(), "cik string")
            for table, df in rows.items():
                store.upsert(table, df)
            store.replace("thirteenf_holdings", rows["filings"], holdings, "accession_number")
            before = store.manifest()["tables"]
            parts = {v: dict(before[v]["folders"]) for v in VIEWS}
            refresh_views(store, some)
            now = store.manifest()["tables"]
            kept = [p for v in VIEWS for p in parts[v] if now[v]["folders"].get(p) == parts[v][p]]
            assert step == 0 or kept
        got = {v: sorted(map(str, store.read(v).collect())) for v in VIEWS}
        refresh_views(store)
        assert got == {v: sorted(map(str, store.read(v).collect())) for v in VIEWS}
        assert got["filer_positions"]


def arrive(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(f"{k},{c},{d}" for k, c, d in lines) + "\n")


def stream_of(spark, folder):
    wanted = spark.createDataFrame([], ddl("filings")).schema
    read = spark.readStream.schema("accession_number string, company_name string, filed_date date").csv(str(folder))
    return read.select(*(F.col(f.name) if f.name in read.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in wanted))


def test_a_stream_corrects_what_was_ingested(spark, store, tmp_path):
    """Streamed rows come after those of a run before them, whatever the number of their batch; a new checkpoint folder too."""
    run = clock()
    store.upsert("filings", frame(spark, "filings", [{"accession_number": k, "company_name": "ingested", "ingest_seq": run + i} for i, k in enumerate("abc")]))
    for step, name in enumerate(("first", "second")):
        arrive(tmp_path / "in", f"{name}.csv", [("a", name, "2024-01-01")])
        run_available(stream_of(spark, tmp_path / "in"), upserting(store, "filings", ["accession_number"]), str(tmp_path / f"progress{step}"))
        assert dict(rows_of(store, "filings", ["accession_number", "company_name"])) in ({"a": name, "b": "ingested", "c": "ingested"}, {"a": "first", "b": "ingested", "c": "ingested"})
    store.upsert("filings", frame(spark, "filings", [{"accession_number": "b", "company_name": "later run", "ingest_seq": clock()}]))
    assert dict(rows_of(store, "filings", ["accession_number", "company_name"]))["b"] == "later run"


def test_a_replayed_batch_changes_nothing(spark, store):
    apply = upserting(store, "filings", ["accession_number"])
    apply(frame(spark, "filings", [{"accession_number": "a", "company_name": "one"}]), 4)
    number = store.manifest()["number"]
    apply(frame(spark, "filings", [{"accession_number": "a", "company_name": "replayed"}]), 4)
    assert store.manifest()["number"] == number and rows_of(store, "filings", ["company_name"]) == [("one",)]


def test_late_rows_are_kept_for_seven_days_and_counted_beyond(spark, store, tmp_path):
    lots = [
        [("a", "x", "2024-01-10"), ("b", "x", "2024-01-20"), ("c", "x", "2023-01-01")],  # nothing seen before: all are kept
        [("d", "x", "2024-01-13"), ("e", "x", "2024-01-12"), ("f", "x", "2024-02-01"), ("g", "x", "")],
        [("h", "x", "2024-01-25"), ("i", "x", "2024-01-24"), ("j", "x", "2024-01-12"), ("a", "again", "2024-01-28")],
    ]
    for i, lot in enumerate(lots):
        arrive(tmp_path / "in", f"{i}.csv", lot)
        for _ in range(2):  # the second time nothing is new
            run_available(stream_of(spark, tmp_path / "in"), upserting_until(store, "filings", "late_filings", ["accession_number"], "filed_date"), str(tmp_path / "progress"))
    assert [k for k, in rows_of(store, "filings", ["accession_number"])] == list("abcdfgh")
    assert dict(rows_of(store, "filings", ["accession_number", "company_name"]))["a"] == "again"
    assert rows_of(store, "late_filings", ["filed_date", "n"]) == [(date(2024, 1, 12), 2), (date(2024, 1, 24), 1)]


def test_growing_tables_are_not_broadcast(spark, tmp_path):
    """Small files may hold many rows: tables that grow with the filings are merged, whatever Spark takes their size for."""
    from ledgerloom.operators import events, positions, upsert
    from ledgerloom.schemas import ddl

    def made(name):
        schema = spark.createDataFrame([], ddl(name)).schema
        spark.range(9).select(*(F.col("id").cast("string").cast(f.dataType).alias(f.name) if f.dataType.simpleString() in ("string", "bigint", "int") else F.lit(None).cast(f.dataType).alias(f.name) for f in schema)).write.parquet(f"{tmp_path}/{name}")
        return spark.read.schema(schema).parquet(f"{tmp_path}/{name}")

    filings, thirteenf, holdings, filers, securities = (made(n) for n in ("filings", "thirteenf_filings", "thirteenf_holdings", "filers", "security_references"))
    identities = positions.filer_identities(filers, filings, thirteenf)
    held = positions.filer_positions(events.effective_holdings(filings, thirteenf, holdings), identities, securities)
    for df, merged in ((identities, 2), (held, 6), (upsert.replace_children(holdings, holdings, filings, ["accession_number"]), 1)):
        plan = df._jdf.queryExecution().sparkPlan().toString()
        assert plan.count("SortMergeJoin") == merged and plan.count("BroadcastHashJoin") == (1 if df is held else 0)  # the one: names by filer
