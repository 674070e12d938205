import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import toxicity
from ledgerloom.llm.lm_score import exchange, likelihood, lm_scores
from ledgerloom.llm.queries import op1_toxicity, op4_lm_score
from ledgerloom.llm.toxicity import drop_toxic, fit, score
from ledgerloom.llm.wordcode import LETTERS, CodeIndex, word_codes

SPACES = re.compile("[^ \t\n\x0b\x0c\r]+")


def lowered(text):
    return (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def words(text):
    return SPACES.findall(lowered(text))


def base(rows, held):
    """Unigram scores by the definition, over (id, text) rows."""
    counts = Counter()
    for key, text in rows:
        if not held(key):
            counts.update([*words(text), None])
    n, v = sum(counts.values()), len(counts)
    out = []
    for key, text in rows:
        tokens = [*words(text), None]
        out.append((key, len(tokens), sum(t in counts for t in tokens), n, sum(math.log10((counts[t] + 0.5) / (n + 0.5 * (v + 1))) for t in tokens)))
    return out


def fold(key, n):
    return zlib.crc32(str("" if key is None else key).encode()) % n


def same(got, want):
    assert len(got) == len(want)
    order = lambda r: (r[0] is not None, r[0] or 0, r[1], r[4])
    for g, w in zip(sorted(got, key=order), sorted(want, key=order), strict=True):
        assert g[:4] == w[:4] and g[4] == pytest.approx(w[4], rel=1e-9, abs=1e-9)


@pytest.mark.parametrize("options", [{}, {"head": 50, "clustered": 20}, {"head": 0}])
def test_base_scores(spark, sf_dir, texts, options):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = lm_scores(docs, F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 1, **options).collect()
    same([(r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got], base(list(texts.items()), lambda k: fold(k, 5) == 1))
    assert all(r.held_out == (fold(r.doc_id, 5) == 1) for r in got)
    if not options:
        held = [r for r in got if r.held_out]
        assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_lm_hard_rows(hard, empty):
    rows = [(r.doc_id, r.text) for r in hard.collect()]
    got = lm_scores(hard, F.coalesce(F.col("doc_id") == 4, F.lit(False)), rounds=1).collect()
    same([(r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got], base(rows, lambda k: k == 4))
    assert lm_scores(empty, F.lit(False)).collect() == []
    nothing = lm_scores(hard.where("doc_id = 1"), F.lit(True)).first()
    assert (nothing.train_tokens, nothing.n_known) == (0, 0)


def test_probabilities_sum_to_one(spark):
    """Over the vocabulary, the end and one unknown word, after each word; by scores alone."""
    text = "a b a c a b a d a b c a b a b c c d a e f"
    vocabulary = [*"abcdef", "?"]
    docs = [(0, text, False), (1, "", True)] + [(100 + 10 * i + j, f"{v} {w}", True) for i, v in enumerate(vocabulary) for j, w in enumerate(vocabulary)] + [(10 + i, v, True) for i, v in enumerate(vocabulary)]
    for options in ({"kinds": 2, "clustered": 3}, {"kinds": 3, "clustered": 2, "head": 5}, {"kinds": 2, "head": 0}):
        got = {r.doc_id: 10**r.score for r in lm_scores(spark.createDataFrame(docs, "doc_id bigint, text string, held boolean"), F.col("held"), rounds=1, **options).collect()}
        n = len(vocabulary)
        # With A[v, w] = P(v w end), a[v] = P(v end) and e[w] = P(end | w): A = first * P(w | v) * e[w].
        ends = np.array([got[10 + i] for i in range(n)])
        both = np.array([[got[100 + 10 * i + j] for j in range(n)] for i in range(n)])
        # P(w | v) e[w] = both[v, w] e[v] / ends[v]; rows that sum to one with e[v] give as many equations as unknown e.
        ratio = both / ends[:, None]
        # Sum over w of ratio[v, w] e[v] / e[w] + e[v] = 1, solved by iteration from what it gives for first words.
        e = np.full(n, 0.1)
        for _ in range(4000):
            e = 0.5 * e + 0.5 / (1 + (ratio / e[None, :]).sum(1))
        first = ends / e
        assert first.sum() + got[1] == pytest.approx(1, abs=1e-6)


def brute_scores(rows, held, classes, pairs, weight_table):
    """Scores by the written formula, word by word."""
    counts = Counter()
    for key, text in rows:
        if not held(key):
            counts.update([*words(text), None])
    out = {}
    for key, text in rows:
        total, before = 0.0, classes(None)
        for w in [*words(text), None]:
            total += math.log10((counts[w] + 0.5) * weight_table[before, classes(w)])
            before = classes(w)
        out[key] = total
    return out


def test_score_by_the_formula(spark, sf_dir, texts, monkeypatch):
    """The model's label and table, once known, give each score word by word; and the table follows from counted bigrams."""
    from ledgerloom.llm import lm_score

    kept = {}
    plain = lm_score.score_texts
    monkeypatch.setattr(lm_score, "score_texts", lambda t, m, r: kept.update(model=m) or plain(t, m, r))
    placed = lm_score._placed
    monkeypatch.setattr(lm_score, "_placed", lambda *a: kept.update(placed=(p := placed(*a))) or p)
    rows = sorted(texts.items())
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r.score for r in lm_scores(docs, F.col("doc_id") % 5 == 1, kinds=5, clustered=40, head=2000).collect()}
    model = kept["model"]
    counts = Counter(w for k, t in rows if k % 5 != 1 for w in words(t))
    floor = -(-model.tokens // 2000)
    codes = {w: int(word_codes([w.encode()])[0][0]) for w in {w for _, t in rows for w in words(t)}}
    order = sorted((w for w in counts if counts[w] >= floor), key=lambda w: (-counts[w], codes[w]))
    placed = {r.code % 2**64: r.kind for r in kept["placed"].collect()}
    numbers = {w: i + 1 for i, w in enumerate(order)}
    classes = lambda w: 6 if w is None else int(model.label[numbers[w]]) if w in numbers else placed.get(codes[w], 5)
    want = brute_scores(rows, lambda k: k % 5 == 1, classes, None, 10**model.table)
    assert all(got[k] == pytest.approx(want[k], rel=1e-9) for k in want)
    pairs, mass, types = np.zeros((7, 7)), np.zeros(7), np.zeros(7)
    for k, t in rows:
        before = None
        for w in [*words(t), None] if k % 5 != 1 else ():
            pairs[classes(before), classes(w)] += 1
            before = w
    for w, n in [*counts.items(), (None, model.ends), ("", 0)]:
        c = 5 if w == "" else classes(w)
        mass[c] += n + 0.5
        types[c] += 1
    assert np.allclose(10**model.table, lm_score.transitions(pairs, mass, types, model.base_divisor), rtol=1e-9)


def contexts(bigrams, classes, kinds):
    """Contexts without self-bigrams, those, and class bigrams, from a matrix of word bigrams."""
    n = len(classes)
    one = np.eye(kinds)[classes]
    off = bigrams * (1 - np.eye(n))
    return np.stack([off.T @ one, off @ one], 1), np.diag(bigrams).astype(float), one.T @ bigrams @ one


@pytest.mark.parametrize("seed", range(30))
def test_exchange_groups_words_by_context(seed):
    """Words 0-9 follow only words 10-19 and the reverse; classes start mixed up."""
    rng = np.random.default_rng(seed)
    halves = np.not_equal.outer(np.arange(20) < 10, np.arange(20) < 10)
    bigrams = rng.integers(1, 5, (20, 20)) * halves
    found = []
    for start in range(5):  # a search by single moves: the best of some starts
        classes = rng.integers(0, 2, 20)
        for round_ in range(12):
            context, again, pairs = contexts(bigrams, classes, 4)
            found.append((likelihood(pairs), classes.copy()))
            mine = np.flatnonzero(rng.random(20) < 0.5)
            classes[mine] = exchange(classes[mine], context[mine], pairs, 2, batch=1, again=again[mine])
    best = max(found, key=lambda x: x[0])
    classes = best[1]
    assert len(set(classes[:10])) == 1 and len(set(classes[10:])) == 1 and classes[0] != classes[10]


@pytest.mark.parametrize("seed", range(20))
def test_a_move_never_lowers_the_likelihood(seed):
    """Each single word, with contexts that are up to date, goes where the exact likelihood is largest."""
    rng = np.random.default_rng(seed)
    bigrams = rng.poisson(0.6, (25, 25)) * rng.integers(1, 6, (25, 25))
    classes = rng.integers(0, 4, 25)
    for _ in range(2):
        for w in range(25):
            context, again, pairs = contexts(bigrams, classes, 5)
            [moved] = exchange(classes[w : w + 1], context[w : w + 1], pairs, 4, again=again[w : w + 1])
            worth = [likelihood(contexts(bigrams, np.where(np.arange(25) == w, c, classes), 5)[2]) for c in range(4)]
            assert worth[moved] == pytest.approx(max(worth), abs=1e-6)
            classes[w] = moved


def test_word_codes():
    texts = [b"Ab  cd\tab", None, b"", b"x" * 5000 + b" " + b"x" * 4999, "é É".encode()]
    codes, of = word_codes(texts)
    assert of.tolist() == [0, 0, 0, 3, 3, 4, 4]
    assert codes[0] == codes[2] and len(set(codes.tolist())) == 6
    assert len(word_codes([b"a1b.c"], LETTERS)[0]) == 3
    keys = np.unique(np.random.default_rng(0).integers(0, 2**63, 5000).astype(np.uint64))
    index = CodeIndex(keys)
    assert (index.find(keys) == np.arange(len(keys))).all()
    assert (index.find(np.random.default_rng(1).integers(0, 2**63, 5000).astype(np.uint64)) == -1).all()
    assert (CodeIndex(keys[:0]).find(keys) == -1).all()


def toxic_docs(spark, n=600):
    rng = np.random.default_rng(3)
    plain = [f"word{i}" .translate(str.maketrans("0123456789", "abcdefghij")) for i in range(200)]
    rows, labels = [], []
    for i in range(n):
        toxic = int(rng.random() < 0.2)
        text = list(rng.choice(plain, 60))
        if toxic:
            for at in rng.integers(0, 60, 5):
                text[at] = str(rng.choice(["nasty", "vile", "awful"]))
        rows.append((i, " ".join(text)))
        labels.append((i, toxic))
    return spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, toxic int")


def test_toxicity_learns(spark):
    docs, labels = toxic_docs(spark)
    model = fit(docs, labels.where("doc_id < 400"))
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    got = {r.doc_id: r.score for r in score(docs, model).collect()}
    held = [i for i in truth if i >= 400]
    assert sum((got[i] >= 0.3) == truth[i] for i in held) >= 0.97 * len(held)
    kept = {r.doc_id for r in drop_toxic(docs, model).collect()}
    assert kept == {i for i, s in got.items() if s < 0.3}


def by_definition(rows):
    """Kneser-Ney probabilities from the written formulas, over (text, toxic) rows: P(class, word, before), None being unknown and the begin."""
    pairs = [Counter(), Counter()]
    for text, c in rows:
        found = [w for w in re.split("[^a-z]+", text.lower()) if w]
        pairs[c].update(zip([None, *found], found))
    both = pairs[0] + pairs[1]
    n = [Counter(), Counter()]
    for c in (0, 1):
        for (_, w), k in pairs[c].items():
            n[c][w] += k
    total, all_ = [sum(n[c].values()) for c in (0, 1)], n[0] + n[1]
    after = Counter(w for _, w in both)

    def apart(counts, totals, factor):
        ratio = [(counts[c] + toxicity.PRIOR) / (sum(counts) / sum(totals) * totals[c] + toxicity.PRIOR) for c in (0, 1)]
        return max(ratio[1] / ratio[0], ratio[0] / ratio[1]) > factor

    d, mass = toxicity.DISCOUNT, sum(total)
    known = [w for w in all_ if all_[w] > 1]
    once = len(all_) - len(known)
    shared = {w: after[w] + 0.5 for w in known} | {None: sum(after.values()) - sum(after[w] for w in known) + 0.5 * (once + 1)}
    shared = {w: x / sum(shared.values()) for w, x in shared.items()}
    told = {w for w in known if apart([n[c][w] for c in (0, 1)], total, toxicity.WORD_FACTOR)}
    backoff = (sum(min(k, d) for k in all_.values()) + once * (1 - d)) / mass
    rest = sum((all_[w] - d) / mass for w in known if w not in told)
    unigram = [{}, {}]
    for c in (0, 1):
        own = {w: max(n[c][w] - d, 0) / total[c] for w in told}
        scale = max(1 - backoff - sum(own.values()), 0) / rest
        kept = own | {w: scale * (all_[w] - d) / mass for w in known if w not in told} | {None: 0.0}
        unigram[c] = {w: kept[w] + (1 - sum(kept.values())) * shared[w] for w in kept}
    follow = [{}, {}]
    around = [Counter(), Counter()]
    for c in (0, 1):
        for (v, _), k in pairs[c].items():
            around[c][v] += k
    for (v, w), k in both.items():
        counts, totals = [pairs[c][v, w] for c in (0, 1)], [max(around[c][v], 1) for c in (0, 1)]
        if k >= toxicity.LEAST_PAIR and apart(counts, totals, toxicity.PAIR_FACTOR):
            for c in (0, 1):
                follow[c][v, w] = max(counts[c] - d, 0) / totals[c]

    def p(c, w, v):
        w = w if w in unigram[c] else None
        return follow[c].get((v, w), 0.0) + (1 - sum(x for (u, _), x in follow[c].items() if u == v)) * unigram[c][w]

    return p, [*known, None], len(follow[0])


def test_probabilities_follow_the_formulas(spark, monkeypatch):
    """Word by word as defined, and each context's sum to one, for both classes."""
    monkeypatch.setattr(toxicity, "PAIR_FACTOR", 3.0)
    rng = np.random.default_rng(4)
    plain, rude = [f"w{c}" for c in "abcdefghijkl"], ["vile", "nasty"]
    rows = []
    for i in range(120):
        c = int(i % 3 == 0)
        found = list(rng.choice(plain, 30, p=np.arange(12, 0, -1) / 78))
        found = [x for w in found for x in ([w, str(rng.choice(rude))] if c and w == "wa" and rng.random() < 0.8 else [w, "rarely" + "abcdefghij"[i % 10] * (i % 7)] if rng.random() < 0.02 else [w])]
        rows.append((" ".join(found), c))
    model = toxicity.learn(spark.createDataFrame(rows, "text string, toxic int"))
    p, known, pairs = by_definition(rows)
    assert pairs > 1
    code = lambda w: word_codes([(w or "zzzz").encode()], LETTERS)[0]
    for v in [*known, "begin"]:
        before = np.zeros(1, np.uint64) if v == "begin" else code(v)
        got = np.stack([model.probabilities(code(w), before)[:, 0] for w in known])
        want = np.array([[p(c, w, None if v == "begin" else v or "zzzz") for c in (0, 1)] for w in known])
        assert np.allclose(got, want, rtol=1e-4)
        assert np.allclose(got.sum(0), 1, atol=1e-4)


def test_toxicity_defined_cases(spark, hard, empty, clashing):
    docs, labels = toxic_docs(spark)
    model = fit(docs, labels)
    got = score(hard, model).collect()
    assert len(got) == hard.count() and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id in (3, 4, 5)}) == 1
    assert score(empty, model).collect() == []
    assert drop_toxic(clashing, model).columns == clashing.columns
    none = fit(docs, labels.where("toxic = 0"))
    assert {r.score for r in score(hard, none).collect()} == {0.0}
    null = labels.limit(5).select("doc_id", F.lit(None).cast("int").alias("toxic"))
    assert {r.score for r in score(hard, fit(docs, null)).collect()} == {0.0}


def test_driver_queries(spark, sf_dir, texts):
    got = op1_toxicity(spark, sf_dir).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    assert all(r.held_out == (fold(r.doc_id, 4) == 2) and r.predicted == (r.score >= 0.3) for r in got)
    assert set(op4_lm_score(spark, sf_dir).columns) >= {"doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"}


def test_words_beyond_the_clustered_have_classes_of_their_own(spark):
    """Of a word beyond the clustered, in the head or outside, its contexts are learnt; the head's size does not matter."""
    rng = np.random.default_rng(6)
    things, deeds = ([f"{kind}{i}" for i in range(150)] for kind in ("thing", "deed"))
    weights = 1 / np.arange(1, 151)
    rows = [(i, " ".join(w for a, b in zip(rng.choice(things, 40, p=weights / weights.sum()), rng.choice(deeds, 40, p=weights / weights.sum())) for w in (a, b)), False) for i in range(150)]
    rows += [(1000, "thing0 " + " ".join(f"deed{i} thing{i}" for i in range(60, 90)), True), (1001, "thing0 " + " ".join(f"thing{i} deed{i}" for i in range(60, 90)) , True)]
    rows += [(1002, "thing70 deed71 never thing72 thing73 seen", True)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, held boolean")
    whole, small = ({r.doc_id: r for r in lm_scores(docs, F.col("held"), kinds=4, clustered=20, head=head).collect()} for head in (1 << 21, 400))
    assert set(whole) == set(small) == {r[0] for r in rows}
    for k in whole:
        assert abs(whole[k].score - small[k].score) < 1e-6 and whole[k].n_known == small[k].n_known
    # The same words but one: in the order of all texts each is about twice as likely as by itself.
    assert all(got[1000].score - got[1000].base_score > 30 * 2 * np.log10(1.5) for got in (whole, small))
