import re
from collections import Counter, defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerloom.llm import licenses, mixing
from ledgerloom.llm.licenses import TEMPLATES, THRESHOLD, scan
from ledgerloom.llm.mixing import OTHER, Plan, budgets, mix, share
from ledgerloom.llm.queries import MIXTURE, op2_mixing, source_domain

PLAN = Plan({"a": 3.0, "b": 1.0}, {"en": 1.0, "de": 1.0}, {"s1": 1.0, "s2": 1.0}, max_epochs=2)


def test_shortages_go_to_siblings_before_ancestors():
    supply = {("a", "en", "s1"): 10, ("a", "en", "s2"): 1000, ("a", "de", "s1"): 1000, ("b", "en", "s1"): 1000}
    got = budgets(supply, PLAN, 800)
    # a has 600: en and de 300 each; s1 is full at 20 and its sibling s2 takes over, not de or b.
    assert got == {("a", "en", "s1"): 20, ("a", "en", "s2"): 280, ("a", "de", "s1"): 300, ("b", "en", "s1"): 200}
    supply[("a", "en", "s2")] = 50
    # With all of a/en full at 120, a/de takes what en lacks; b still keeps its share.
    assert budgets(supply, PLAN, 800) == {("a", "en", "s1"): 20, ("a", "en", "s2"): 100, ("a", "de", "s1"): 480, ("b", "en", "s1"): 200}
    supply[("a", "de", "s1")] = 100
    assert budgets(supply, PLAN, 800) == {("a", "en", "s1"): 20, ("a", "en", "s2"): 100, ("a", "de", "s1"): 200, ("b", "en", "s1"): 480}


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 500), st.lists(st.tuples(st.floats(0, 5), st.integers(0, 200)), max_size=6))
def test_share_uses_the_whole_budget(budget, children):
    got = share(budget, [c[0] for c in children], [c[1] for c in children])
    assert sum(got) == min(budget, sum(c[1] for c in children))
    assert all(0 <= g <= c[1] for g, c in zip(got, children, strict=True))


def check_mix(got, rows, plan, budget_share=1.0):
    """`rows`: id, leaf, tokens. Whole epochs, then a prefix whose last document is cut."""
    supply = Counter()
    for _, leaf, n in rows:
        supply[leaf] += n
    wanted = budgets(supply, plan, int(budget_share * sum(supply.values())))
    by_leaf = defaultdict(list)
    for r in got:
        by_leaf[r.domain, r.lang, r.source].append(r)
    for leaf, tokens in wanted.items():
        mine = by_leaf[leaf]
        assert sum(r.taken for r in mine) == tokens, leaf
        whole, rest = divmod(tokens, supply[leaf]) if supply[leaf] else (0, 0)
        assert Counter(r.epoch for r in mine if r.epoch < whole) == Counter({e: sum(1 for _, lf, _ in rows if lf == leaf) for e in range(whole)})
        assert sum(0 < r.taken < r.n_tokens for r in mine) <= 1
        assert sum(r.taken for r in mine if r.epoch == whole) == rest


def test_mixing(spark, sf_dir, tables, monkeypatch):
    monkeypatch.setattr(mixing, "RANGE_DOCS", 2)
    got = op2_mixing(spark, sf_dir).collect()
    domains = ("web", "reference", "forum", "news")
    rows = [(k, (domains[int(s[3:]) % 4], lang, s), len((t or "").split())) for k, t, lang, s in tables.sql("SELECT doc_id, text, lang, source FROM documents").fetchall()]
    check_mix(got, rows, MIXTURE)
    again = op2_mixing(spark, sf_dir).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))


def test_mixing_hard_rows(hard, clashing, empty):
    got = mix(clashing, MIXTURE, F.lit("web"), 0.5)
    assert got.columns[: len(clashing.columns)] == [f"c{i}" for i in range(len(clashing.columns))]
    sources, languages = set(MIXTURE.sources), set(MIXTURE.languages)
    rows = [(r.doc_id, ("web", r.lang if r.lang in languages else OTHER, r.source if r.source in sources else OTHER), len(re.findall("[^ \t\n\x0b\x0c\r]+", r.text or ""))) for r in hard.collect()]
    check_mix(got.collect(), rows, MIXTURE, 0.5)
    assert mix(empty, MIXTURE, source_domain()).collect() == []
    assert mix(hard, MIXTURE, source_domain(), 0.0).where("taken > 0").collect() == []


def plain_bigrams(text):
    found = re.findall("[a-z0-9]+", (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    return list(zip(found, found[1:]))  # noqa: B905


def brute_license(text):
    """Every window of every template's size, without any pruning."""
    mine, found = plain_bigrams(text), []
    for name, versions in TEMPLATES.items():
        for version in versions:
            theirs = plain_bigrams(version)
            size = min(len(theirs), len(mine))
            for start in range(len(mine) - size + 1) if size else ():
                dice = 2 * sum((Counter(mine[start : start + size]) & Counter(theirs)).values()) / (size + len(theirs))
                if dice >= THRESHOLD - 1e-9:
                    found.append((-dice, -len(theirs), start, name))
    chosen = []
    for f in sorted(found):
        if all(f[2] - f[1] < c[2] or c[2] - c[1] < f[2] for c in chosen):
            chosen.append(f)
    return (chosen[0][3] if chosen else None, -chosen[0][0] if chosen else None, len(chosen), ",".join(sorted({c[3] for c in chosen})))


def test_licenses(spark, texts, hard, empty):
    edited = TEMPLATES["MIT"][1].replace("person", "human being").replace("merge", "join")
    rows = [(10_000 + i, v) for i, v in enumerate(v for vs in TEMPLATES.values() for v in vs)]
    rows += [
        (20_000, "It is released under the MIT license."),
        (20_001, "x\n\nreleased under\nthe MIT License\n\ny"),
        (20_002, "a b " * 1000),
        (20_003, "This library is released under the MIT License and welcomes patches from everyone."),
        (20_004, "prose " * 50 + edited + " more prose" * 50 + " Released under the MIT License. And licensed under CC BY 4.0."),
        (20_005, "under the MIT"),
        (20_006, " ".join(TEMPLATES["GPL-3.0"][1].split()[:25])),
        (20_007, "Released under the MIT License. " * 3),
    ]
    rows += [(k, t) for k, t in texts.items() if len(t or "") < 1500]
    got = {r.doc_id: r for r in scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    for key, text in rows:
        name, dice, n, names = brute_license(text)
        r = got[key]
        assert (r.license, r.n_units, r.licenses) == (name, n, names), text
        assert (r.dice is None) == (dice is None) and (dice is None or abs(r.dice - dice) < 1e-12)
    assert [got[k].licenses for k in (20_000, 20_001, 20_002, 20_003, 20_004, 20_007)] == ["MIT", "MIT", "", "MIT", "CC-BY-4.0,MIT", "MIT"]
    assert got[20_004].n_units == 3 and got[20_007].n_units == 3
    assert {r.licenses for r in scan(hard).where("doc_id = 10").collect()} == {"CC-BY-NC-4.0,MIT"}
    assert scan(hard).count() == hard.count() and scan(empty).collect() == []


def test_very_many_notices_in_one_text():
    """Work grows with the text: four times the notices take nowhere near sixteen times as long, and all are found."""
    import time

    book = licenses.Templates(licenses.TEMPLATES, licenses.THRESHOLD)
    notice = next(texts[0] for name, texts in sorted(licenses.TEMPLATES.items()) if len(texts[0].split()) > 8)
    took = []
    for n in (1500, 6000):
        text = f" {' '.join(f'gap{i}' for i in range(40))} ".join([notice] * n).encode()
        begun = time.process_time()
        (found,) = book.scan([text])
        took.append(time.process_time() - begun)
        assert len(found) == n
    assert took[1] < 10 * took[0] + 0.5
