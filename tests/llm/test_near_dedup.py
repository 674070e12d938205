import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from ledgerloom.llm import near_dedup
from ledgerloom.llm.graph import components
from ledgerloom.llm.near_dedup import BUCKET, block_masks, bucket_links, distance_table, drop_near_duplicates, drop_similar, links, near_duplicates, pivots, set_links, similar_groups, sorted_links


def fingerprint(text, words=4):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    parts = [w for w in lowered.replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ") if w]
    shingles = [" ".join(parts[i : i + words]) for i in range(len(parts) - words + 1)] or ([" ".join(parts)] if parts else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(items, linked):
    parent = {i: i for i in items}

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for a, b in linked:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    return {i: find(i) for i in items}


def brute(rows, distance=4):
    prints = {(i, k): fingerprint(t) for i, (k, t) in enumerate(rows)}
    found = roots(prints, [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= distance])
    least = {}
    for item, root in found.items():
        if item[1] is not None:
            least[root] = min(least.get(root, item[1]), item[1])
    return sorted(((item[1], f"{prints[item]:016x}", least.get(root)) for item, root in found.items()), key=str)


def test_against_brute_force(spark, sf_dir, texts, hard, empty):
    got = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    assert sorted((tuple(r)[:3] for r in got.collect()), key=str) == brute([(k, t) for k, t in texts.items()])
    rows = [(r.doc_id, r.text if r.doc_id != 6 else "word word word word") for r in hard.collect()]
    small = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert sorted((tuple(r)[:3] for r in near_duplicates(small).collect()), key=str) == sorted(brute_nullable(rows), key=str)
    assert near_duplicates(empty).collect() == []


def brute_nullable(rows):
    prints = [fingerprint(t) for _, t in rows]
    found = roots(range(len(rows)), [(a, b) for a in range(len(rows)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 4])
    out = []
    for i, (key, _) in enumerate(rows):
        ids = [rows[j][0] for j in found if found[j] == found[i] and rows[j][0] is not None]
        out.append((key, f"{prints[i]:016x}", min(ids, default=None)))
    return out


def test_drop(clashing, hard):
    kept = drop_near_duplicates(clashing)
    assert kept.columns == clashing.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(1) == 1 and 11 not in ids and 2 not in ids and 9 in ids and 10 in ids


def clustered_prints(seed, n=400):
    rnd = random.Random(seed)
    centres = [rnd.getrandbits(64) for _ in range(20)]
    return sorted({c ^ sum(1 << b for b in rnd.sample(range(64), rnd.randrange(6))) for c in centres for _ in range(n // 20)})


@pytest.mark.parametrize("bucket", [20_000, 8])
def test_links_keep_components(spark, bucket):
    prints = clustered_prints(bucket)
    df = spark.createDataFrame([(p - 2**64 if p >= 2**63 else p,) for p in prints], "fp bigint")
    linked = [(r.child % 2**64, r.root % 2**64) for r in links(df, 4, bucket).collect()]
    assert roots(prints, linked) == roots(prints, [(a, b) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= 4])


def test_masks_miss_no_pair():
    rnd = random.Random(9)
    for prints in (100, 10**6, 10**9):
        masks = block_masks(prints, 4)
        for _ in range(300):
            difference = sum(1 << b for b in rnd.sample(range(64), 4))
            assert any(not difference & m for m in masks)
    assert len(block_masks(10**9, 4)) > len(block_masks(10**6, 4))


def test_bucket_links_equal_all_pairs():
    prints = np.array(clustered_prints(3, 200), np.uint64)[:, None]
    keys = np.repeat(np.arange(40), 5)[: len(prints)]
    for k, p in ((keys, prints), (np.zeros(len(prints), np.int64), prints)):
        a, b = sorted_links(k, p, 4, distance_table(p, pivots()))
        want = [(i, j) for i, x in enumerate(p[:, 0]) for j, y in enumerate(p[:, 0]) if i < j and k[i] == k[j] and (int(x) ^ int(y)).bit_count() <= 4]
        items = range(len(p))
        assert roots(items, zip(a.tolist(), b.tolist(), strict=True)) == roots(items, want)
    assert len(bucket_links(prints, 4, distance_table(prints, pivots()))[0]) < len(prints)


def test_components_of_paths_stars_and_rings(spark):
    rnd = random.Random(7)
    pairs = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 300)] + [(2000 + i, 2000 + (i + 1) % 50) for i in range(50)]
    pairs += [(rnd.randrange(3000, 3400), rnd.randrange(3000, 3400)) for _ in range(250)]
    rnd.shuffle(pairs)
    names = {n: rnd.randrange(-(2**62), 2**62) for p in pairs for n in p}
    df = spark.createDataFrame([(names[a], names[b]) for a, b in pairs], "child bigint, root bigint").repartition(7)
    got = {r.child: r.root for r in components(df).collect()}
    want = roots(names.values(), [(names[a], names[b]) for a, b in pairs])
    assert {n: got.get(n, n) for n in want} == want
    assert components(df.where(F.lit(False))).count() == 0


def edited(rnd, words, share):
    out = list(words)
    for at in rnd.sample(range(len(out)), max(1, int(share * len(out)))):
        out[at] = f"new{rnd.randrange(10**6)}"
    return out


@pytest.mark.parametrize("bucket", [BUCKET, 25])
def test_similar_groups(spark, bucket):
    """Copies with a few words changed are grouped, whatever their number; other texts stay apart."""
    rnd = random.Random(12)
    rows, group = [], {}
    for g in range(60):
        base = [f"w{rnd.randrange(5000)}" for _ in range(300)]
        for _ in range(40 if g == 0 else rnd.choice([1, 2, 3])):
            group[len(rows)] = g
            rows.append((len(rows), " ".join(edited(rnd, base, 0.008))))
    got = {r.doc_id: r.component_id for r in similar_groups(spark.createDataFrame(rows, "doc_id bigint, text string"), bucket=bucket).collect()}
    assert set(got) == set(group)
    assert all(group[c] == group[k] for k, c in got.items())
    least = {g: min(k for k in group if group[k] == g) for g in set(group.values())}
    missed = sum(got[k] != least[group[k]] for k in got)
    assert missed <= 0.05 * len(got)


def test_dropping_tells_rows_of_an_id_apart(spark):
    """An id with several texts loses only those that duplicate another id's."""
    rows = [(1, "a b c d e f g h"), (2, "a b c d e f g h"), (2, "one two three four five six seven"), (None, "a b c d e f g h"), (3, None), (4, "")]
    for drop in (drop_near_duplicates, drop_similar):
        got = drop(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
        assert sorted(map(tuple, got), key=str) == sorted([rows[0], rows[2], rows[3], rows[4]], key=str)


@pytest.mark.parametrize("family", [1 << 20, 400])
def test_dense_family_equals_brute_force(spark, family):
    """Many texts near each other, about as many pairs above the threshold as below; in one chunk and in several."""
    rnd = random.Random(31)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(120):
        words, at = list(base), rnd.randrange(100)
        words[at : at + rnd.randrange(1, 14)] = [f"v{rnd.randrange(10**6)}" for _ in range(rnd.randrange(1, 14))]
        rows.append((i, " ".join(words)))
    similar = [(a, b) for a, x in rows for b, y in rows if a < b and set_similarity(x, y) >= 0.8]
    assert len(rows) < len(similar) < 0.9 * 120 * 119 / 2
    got = {r.doc_id: r.component_id for r in similar_groups(spark.createDataFrame(rows, "doc_id bigint, text string"), family=family).collect()}
    assert got == roots(range(120), similar)


def test_a_full_bitmap_loses_nothing(spark, monkeypatch):
    """Beyond its bound the bitmap picks too many texts, never too few."""
    from ledgerloom.llm import near_dedup as N

    monkeypatch.setattr(N, "BITMAP", 64)
    rng = np.random.default_rng(12)
    rows = []
    for family in range(40):
        words = [f"w{family}x{w}" for w in rng.integers(0, 10_000, 120)]
        rows += [(family * 10, " ".join(words)), (family * 10 + 1, " ".join([*words, "end"])), (family * 10 + 2, " ".join(words[:40]))]
    got = {r.doc_id: r.component_id for r in similar_groups(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == {i: i - (i % 10 == 1) for i, _ in rows}


def test_set_links_equal_all_pairs():
    rng = np.random.default_rng(5)
    for n in (2, 30, 80):
        sets = [np.unique(rng.integers(0, 40, rng.integers(1, 30))).astype(np.uint64) for _ in range(n)]
        want = [(i, j) for i, x in enumerate(sets) for j, y in enumerate(sets) if i < j and len(np.intersect1d(x, y)) >= 0.5 * len(np.union1d(x, y))]
        a, b = set_links(sets, 0.5)
        assert roots(range(n), zip(a.tolist(), b.tolist(), strict=True)) == roots(range(n), want)


def test_similar_hard_rows(hard, empty):
    got = similar_groups(hard).collect()
    assert len(got) == hard.count()
    assert {r.component_id for r in got if r.doc_id in (1, 2, 11)} == {1}
    assert {r.component_id for r in got if r.doc_id in (3, 4, 5)} == {3}
    assert similar_groups(empty).collect() == []


def set_similarity(x, y):
    a, b = ({tuple(t[i : i + 5]) for i in range(len(t) - 4)} for t in (x.split(), y.split()))
    return len(a & b) / len(a | b)


def pairs_about_the_threshold(seed, count):
    """Pairs of texts of unlike lengths, changed in runs of words so that their similarity is between 0.75 and 0.9."""
    rnd, out = random.Random(seed), []
    while len(out) < count:
        n = rnd.choice([60, 120, 300, 600])
        base = [f"w{rnd.randrange(5000)}" for _ in range(n)]
        other, at = list(base), rnd.randrange(n // 2)
        run = max(1, int(n * rnd.uniform(0.02, 0.14)))
        other[at : at + run] = [f"v{rnd.randrange(10**6)}" for _ in range(run)]
        x, y = " ".join(base), " ".join(other)
        if 0.75 <= set_similarity(x, y) <= 0.9:
            out.append((x, y))
    return out


@pytest.mark.parametrize("bucket", [BUCKET, 2])
def test_similar_groups_equal_brute_force_about_the_threshold(spark, bucket):
    """Just the pairs that reach 0.8 are grouped: none below, and all above."""
    pairs = pairs_about_the_threshold(4, 400)
    rows = [(2 * i + k, text) for i, pair in enumerate(pairs) for k, text in enumerate(pair)]
    got = {r.doc_id: r.component_id for r in similar_groups(spark.createDataFrame(rows, "doc_id bigint, text string"), bucket=bucket).collect()}
    want = {2 * i + k: 2 * i if set_similarity(*pair) >= 0.8 else 2 * i + k for i, pair in enumerate(pairs) for k in (0, 1)}
    assert 100 < sum(k != c for k, c in want.items()) < 300
    assert got == want


def test_links_that_the_first_text_of_a_bucket_does_not_give(spark):
    """Texts in a chain, each near its neighbours only, are one group whichever of them is first in a bucket."""
    rnd = random.Random(8)
    text, rows = [f"w{i}" for i in range(400)], []
    for i in range(30):
        rows.append((i, " ".join(text)))
        text[12 * i : 12 * i + 30] = [f"v{rnd.randrange(10**9)}" for _ in range(30)]
    assert set_similarity(rows[0][1], rows[1][1]) >= 0.8 > set_similarity(rows[0][1], rows[3][1])
    got = similar_groups(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert len(got) == 30 and {r.component_id for r in got} == {0}


def test_candidates_by_fingerprints(spark):
    """Nodes whose fingerprints are within four bits are linked, and those of one fingerprint."""
    rng = random.Random(3)
    prints = [rng.getrandbits(64) for _ in range(40)]
    prints += [p ^ sum(1 << b for b in rng.sample(range(64), n)) for p in prints[:20] for n in (0, 3, 4, 7)]
    nodes = [(i * 7 + 5, p - 2**64 if p >= 2**63 else p) for i, p in enumerate(prints)]
    got = near_dedup._print_links(spark.createDataFrame(nodes, "node bigint, fp bigint"), BUCKET).collect()
    root = {n: n for n, _ in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, _) in enumerate(nodes):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                root[find(a)] = find(nodes[j][0])
    want = {frozenset(n for n, _ in nodes if find(n) == r) for r in set(map(find, root))}
    own = {n: n for n in root}

    def top(x):
        while own[x] != x:
            x = own[x]
        return x

    for r in got:
        own[top(r.child)] = top(r.root)
    assert {frozenset(n for n in own if top(n) == r) for r in set(map(top, own))} == want


def test_the_stage_searches_fingerprints_by_pivot_tables(spark, monkeypatch):
    """Every different fingerprint of the texts takes part in the search by blocks and pivot tables."""
    asked = []
    real = near_dedup.links
    monkeypatch.setattr(near_dedup, "links", lambda prints, *how: asked.append((prints.count(), how[0])) or real(prints, *how))
    words = [f"w{i}" for i in range(60)]
    rows = [(0, " ".join(words)), (1, " ".join([*words, "more"])), (2, " ".join(words[::-1])), (3, " ".join(words))]
    kept = drop_similar(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert sorted(r.doc_id for r in kept.collect()) == [0, 2] and asked == [(3, 4)]
