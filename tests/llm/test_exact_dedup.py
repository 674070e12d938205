import hashlib
import random

from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerloom.llm import exact_dedup, queries
from ledgerloom.llm.exact_dedup import Group, combined, drop_exact_duplicates, exact_duplicates, grace, text_digest


def brute(rows):
    groups = {}
    for key, text in rows:
        groups.setdefault("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""), []).append(key)
    return groups


def test_against_sql(spark, sf_dir, tables):
    got = exact_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    want = tables.sql(queries.oracle_sql()["op10_exact_dedup"])
    assert sorted(map(tuple, got.select(want.columns).collect())) == sorted(want.fetchall())


def test_hard_rows(hard, clashing):
    got = exact_duplicates(hard).collect()
    groups = brute([(r.doc_id, r.text) for r in hard.collect()])
    assert len(got) == hard.count()
    by_sha = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    for row in got:
        ids = by_sha[row.text_sha256]
        assert row.group_size == len(ids)
        assert row.keep_id == max((i for i in ids if i is not None), default=None)
    for sha, ids in by_sha.items():
        assert sum(r.kept for r in got if r.text_sha256 == sha) == 1, ids
    kept = drop_exact_duplicates(clashing)
    assert kept.columns == clashing.columns
    assert kept.count() == len(groups)
    assert {r.doc_id for r in kept.where("text = 'alpha BETA gamma delta epsilon.'").collect()} == {11}


def test_a_third_of_the_rows_are_one_row(spark, monkeypatch):
    """Each of them is written out, in blocks, and one stays; ids may be null."""
    monkeypatch.setattr(exact_dedup, "BLOCK", 7)
    rows = [(9, "Same text")] * 100 + [(3, "same text")] * 4 + [(None, "no id")] * 22 + [(i, f"text {i % 50}") for i in range(100, 200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = exact_duplicates(docs).groupBy("doc_id", "keep_id", "group_size", "text_sha256", "kept").count().collect()
    groups = brute(rows)
    sha = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    for r in got:
        ids = sha[r.text_sha256]
        top = max((i for i in ids if i is not None), default=None)
        assert (r.keep_id, r.group_size) == (top, len(ids))
        assert r["count"] == (1 if r.kept else ids.count(r.doc_id) - (r.doc_id == top))
    assert sum(r["count"] for r in got) == len(rows)
    assert sum(r["count"] for r in got if r.kept) == len(groups)


def test_empty(empty):
    assert exact_duplicates(empty).collect() == []
    assert drop_exact_duplicates(empty).columns == empty.columns


def as_groups(rows):
    return [Group(text_digest(t), 1, 1, k, t, (k, t)) for k, t in rows]


def test_spills_and_recursion():
    rnd = random.Random(5)
    rows = [(i, f"text {rnd.randrange(300)} " * rnd.choice((1, 1, 200))) for i in range(3000)]
    got = {g.text.lower(): (g.size, g.key) for g in grace(combined(as_groups(rows), budget=20_000), budget=20_000)}
    assert got == {t: (len(ids), max(ids)) for t, ids in brute(rows).items()}


def test_equal_digests_are_not_equal_texts():
    groups = [Group(b"\0" * 32, 1, 1, i, t, (i, t)) for i, t in enumerate(["a", "b", "A", "c"] * 3)]
    assert sorted((g.text.lower(), g.size) for g in grace(groups, budget=1)) == [("a", 6), ("b", 3), ("c", 3)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 9)), st.one_of(st.none(), st.text("aAbBé ", max_size=3))), max_size=40), st.integers(1, 2000))
def test_any_rows(rows, budget):
    got = {g.text or "": (g.size, g.key) for g in grace(combined(as_groups(rows), budget), budget)}
    lowered = {"".join(c.lower() if c in "AB" else c for c in t): v for t, v in got.items()}
    assert lowered == {t: (len(ids), max((i for i in ids if i is not None), default=None)) for t, ids in brute(rows).items()}
