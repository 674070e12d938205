"""Personal data: overlapping candidate spans, boosted trees, calibrated thresholds.

Generators of high recall propose spans: the four base patterns before their
checks, and looser ones for spelled-out addresses, for written-apart IPs and
for runs of digits with any punctuation. A span that a base pattern finds and
its check accepts is always reported. For the rest, gradient-boosted trees
over features of format and context give the probability that a candidate of
its kind is personal data; per kind the smallest threshold with the wanted
precision selects what is added, and of overlapping additions the best one
stays.

There are no labelled spans. The loose generators also find what a base
pattern accepts; those are the positive examples, with the marks that base
patterns need (an at sign, a plus and country code, the kind of separator, dots
between the parts) hidden from the features. Candidates that something speaks
against (letters or digits right beside them, a failed checksum or range, the
shape of a date, a cue for another kind) are the negative ones. Of the others,
which nothing speaks for or against, UNKNOWN are taken to be something else.
Thresholds are calibrated on documents that the trees have not seen.

Everything is DataFrame and SQL functions. The trees learn from all
candidates: features are small integers, so one aggregation gives every
combination with its counts (CELLS at most, whatever the size of the corpus),
from which the driver grows the trees; they are applied as one CASE
expression. A generator's spans never overlap and come in order, so what a span
touches is found by halving its list: time stays near linear in the spans of a
text. Positions are counted from the lengths of what lies between the
matches, in code points. The patterns are free of nested repetition of
variable length, so that their time stays linear and the stack flat.

Defined cases: a null text counts as empty; such documents, and any without
spans, have counts of zero and empty strings. Rows that repeat a document are
each reported. Without candidates of both outcomes nothing is added. An empty
table gives no rows. Columns other than the id and the text are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved

KINDS = ("email", "ip", "card", "phone")
_LOCAL, _HOST = "A-Za-z0-9._%+-", "A-Za-z0-9-"
#: A match of the first pattern begins where its run of characters does, or where the last match ended.
BASE = (
    rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[{_HOST}]++\.[{_HOST}](?:(?!\.[^{_HOST}]|\.\z)[{_HOST}.])*+",
    r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    r"[0-9](?:(?![\x20-](?![0-9]))[\x200-9-])++",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)
_AT, _DOT = r" ?(?:@|[(\[]at[)\]]| at ) ?", r" ?(?:\.|[(\[]dot[)\]]| dot ) ?"
LOOSE = (
    rf"(?<![{_LOCAL}])[{_LOCAL}]++{_AT}[{_HOST}]++{_DOT}[{_HOST}]++(?:{_DOT}[{_HOST}]++)?(?:{_DOT}[{_HOST}]++)?",
    r"[+(]{0,2}[0-9][0-9 ().:/_-]{5,60}[0-9]",
    r"(?<![0-9.])[0-9]{1,3}" + r"(?: ?[(\[]?(?:\.| dot |dot)[)\]]? ?)[0-9]{1,3}" * 3 + r"(?![0-9])",
)
#: Checks that the base patterns' matches must pass, over a match m.
CHECKS = (
    "true",
    "forall(split(m, '[.]'), p -> coalesce(try_cast(concat('0', trim(LEADING '0' FROM p)) AS int), 999) <= 255)",
    "length(translate(m, ' -', '')) BETWEEN 12 AND 19 AND luhn_check(translate(m, ' -', ''))",
    "length(translate(m, '+ ().-', '')) BETWEEN 9 AND 15",
)
#: Words near a candidate that hint at its kind.
CUES = ("e-?mail|mailto|contact|write to", r"\bip\b|host|server|address", "card|visa|credit|payment", "phone|call|tel\\b|mobile|fax")
FEATURES = ("kind", "digits", "sep", "groups", "last", "prev", "next", "cue", "valid")
#: Endings of host names that are not countries'.
DOMAINS = ("com", "org", "net", "edu", "gov", "info", "io", "biz")
#: Matches in one block of positions.
BLOCK = 128
#: Values that each feature takes at most; their product bounds what the driver gets.
SIZES = (4, 22, 3, 7, 6, 5, 5, 3, 2)
CELLS = int(np.prod(SIZES))
#: Share of candidates without evidence that count as something else; one document in so many calibrates the thresholds.
UNKNOWN, FOLDS = 0.2, 3
TREES, DEPTH, RATE, PRECISION = 24, 4, 0.4, 0.95
#: Positive examples that a threshold must have been held against.
LEAST_HELD = 5


def _char_class(c: str) -> str:
    return rf"CASE WHEN {c} = '' THEN 0 WHEN {c} RLIKE '^\\s' THEN 1 WHEN {c} RLIKE '^[0-9]' THEN 2 WHEN {c} RLIKE '^\\p{{L}}' THEN 3 ELSE 4 END"


def _bound(name: str, value: str, body: str) -> str:
    """SQL in which `body` uses `value` by name: it is computed once a row, not once an element."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _touched(spans: str, x: str = "x") -> str:
    """SQL for the elements of `spans`, which are in order and apart from each other, that share a place with `x`: from the first one that ends behind its start to the last one that starts before its end."""

    def first(test: str) -> str:
        middle = "shiftright(s.lo + s.hi, 1)"
        halve = f"CASE WHEN s.lo >= s.hi THEN s WHEN get({spans}, {middle}).{test} THEN named_struct('lo', s.lo, 'hi', {middle}) ELSE named_struct('lo', {middle} + 1, 'hi', s.hi) END"
        return f"aggregate(sequence(0, cast(log2(size({spans}) + 1) AS int) + 1), named_struct('lo', 0, 'hi', size({spans})), (s, i) -> {halve}, s -> s.lo)"

    from_, to = first(f"end > {x}.start"), first(f"start >= {x}.end")
    return f"CASE WHEN size({spans}) = 0 THEN {spans} ELSE {_bound('p', from_, f'slice({spans}, p + 1, {to} - p)')} END"


#: Base spans of a text, a list for each kind.
_BY_KIND = "array(" + ", ".join(f"filter(c, y -> y.ok AND y.kind = {k})" for k in range(len(KINDS))) + ")"


def _spans(gen: int) -> str:
    """SQL for the spans of generator `gen`, from its matches m{gen} and the text between them g{gen}."""
    kind = f"{gen}" if gen < 4 else "0" if gen == 4 else "1" if gen == 6 else "CASE WHEN all_ BETWEEN 12 AND 19 THEN 2 ELSE 3 END"
    check = CHECKS[gen] if gen < 4 else "false"
    bare = "regexp_replace(m, '^[+][0-9]{1,3}(?=[^0-9])[ .(-]*', '')"  # without a country code
    marks = "regexp_replace(b, '[0-9A-Za-z]', '')"
    runs = "filter(split(b, '[^0-9]+'), p -> p != '')"
    beside = f"{_char_class('right(c, 1)')}", f"{_char_class(f'left(g{gen}[s.i + 1], 1)')}"
    cue = "CASE " + " ".join(f"WHEN c RLIKE '(?i){w}' THEN {i + 1}" for i, w in enumerate(s.replace("\\", "\\\\") for s in CUES)) + " ELSE 0 END"
    valid = f"""CASE k WHEN 0 THEN lower(regexp_extract(m, '([A-Za-z0-9-]+)$', 1)) RLIKE '^({"|".join(DOMAINS)}|[a-z]{{2}})$'
        WHEN 1 THEN forall(filter(split(m, '[^0-9]+'), p -> p != ''), p -> coalesce(try_cast(concat('0', trim(LEADING '0' FROM p)) AS int), 999) <= 255)
        WHEN 2 THEN luhn_check(regexp_replace(m, '[^0-9]', '')) ELSE all_ BETWEEN 7 AND 15 END"""
    digits = "k >= 2"  # of the other kinds' formats only the check counts
    body = f"""named_struct('kind', k, 'start', s.a, 'end', s.a + length(m), 'ok', coalesce({check}, false), 'gen', {gen},
        'digits', CASE WHEN {digits} THEN least(21, aggregate(r, 0, (t, p) -> t + length(p))) ELSE 0 END,
        'sep', CASE WHEN NOT {digits} OR {marks} = '' THEN 0 WHEN {marks} RLIKE '^(.)\\\\1*$' THEN 1 ELSE 2 END,
        'groups', CASE WHEN {digits} THEN least(6, size(r)) ELSE 0 END, 'last', CASE WHEN {digits} THEN least(5, length(element_at(r, -1))) ELSE 0 END,
        'prev', {beside[0]}, 'next', {beside[1]}, 'cue', CASE WHEN q = 0 THEN 0 WHEN q = k + 1 THEN 1 ELSE 2 END, 'valid', cast(coalesce({valid}, false) AS int),
        'date', m RLIKE '^((19|20)[0-9]{{2}}[-/.][0-9]{{1,2}}[-/.][0-9]{{1,2}}|[0-9]{{1,2}}[-/.][0-9]{{1,2}}[-/.]((19|20)[0-9]{{2}}|[0-9]{{2}}))$')"""
    each = _bound("k", kind, _bound("b", bare, _bound("r", f"CASE WHEN {digits} THEN {runs} ELSE array('') END", _bound("q", cue, body))))
    each = _bound("m", f"m{gen}[s.i]", _bound("c", f"right(g{gen}[s.i], 24)", _bound("all_", "length(regexp_replace(m, '[^0-9]', ''))", each)))
    # Where a match begins: sums of lengths over whole blocks before it, then within its block, so time stays near linear in the matches.
    lengths = f"zip_with(m{gen}, slice(g{gen}, 1, size(m{gen})), (m, g) -> length(g) + length(m))"
    sums = f"transform(sequence(0, (size(l) - 1) DIV {BLOCK}), b -> aggregate(slice(l, b * {BLOCK} + 1, {BLOCK}), 0, (t, x) -> t + x))"
    blocks = f"aggregate({sums}, array(0), (t, x) -> concat(t, array(element_at(t, -1) + x)))"
    begin = f"named_struct('i', i, 'a', z[i DIV {BLOCK}] + aggregate(slice(l, (i DIV {BLOCK}) * {BLOCK} + 1, i % {BLOCK}), 0, (t, x) -> t + x) + length(g{gen}[i]))"
    places = _bound("l", lengths, _bound("z", blocks, f"transform(sequence(0, size(l) - 1), i -> {begin})"))
    return f"CASE WHEN size(m{gen}) = 0 THEN array() ELSE transform({places}, s -> {each}) END"


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and all proposed spans `c`: kind, start, end, whether a base check accepts it (`ok`), and the features."""
    gens = range(len(BASE) + len(LOOSE))
    patterns = (*BASE, *LOOSE)
    text = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    found = text.select("*", *(F.regexp_extract_all("text", F.lit(patterns[g]), F.lit(0)).alias(f"m{g}") for g in gens))
    between = found.select("doc_id", *(f"m{g}" for g in gens), *(F.when(F.size(f"m{g}") > 0, F.split("text", patterns[g], -1)).alias(f"g{g}") for g in gens))
    shape = "array<struct<kind:int,start:int,end:int,ok:boolean,gen:int,digits:int,sep:int,groups:int,last:int,prev:int,next:int,cue:int,valid:int,date:boolean>>"
    return between.select("doc_id", F.expr("concat(" + ", ".join(f"cast({_spans(g)} AS {shape})" for g in gens) + ")").alias("c"))


class Trees:
    """Gradient boosting for logistic loss over weighted cells of integer features."""

    def __init__(self, x: np.ndarray, pos: np.ndarray, neg: np.ndarray, trees: int = TREES, depth: int = DEPTH, rate: float = RATE):
        self.base = float(np.log((pos.sum() + 1) / (neg.sum() + 1)))
        self.trees: list = []
        score = np.full(len(x), self.base)
        for _ in range(trees):
            p = 1 / (1 + np.exp(-score))
            grad, hess = pos - (pos + neg) * p, (pos + neg) * p * (1 - p)
            tree = self._grow(x, grad, hess, np.arange(len(x)), depth, rate)
            self.trees.append(tree)
            score = score + self._values(tree, x)

    def _grow(self, x, grad, hess, rows, depth, rate):
        g, h = grad[rows].sum(), hess[rows].sum()
        best = (1e-6, None, None)
        for f in range(x.shape[1]) if depth else ():
            size = int(x[rows, f].max()) + 1
            gl, hl = np.cumsum(np.bincount(x[rows, f], grad[rows], size))[:-1], np.cumsum(np.bincount(x[rows, f], hess[rows], size))[:-1]
            if len(gl):
                gain = gl**2 / (hl + 1) + (g - gl) ** 2 / (h - hl + 1) - g**2 / (h + 1)
                at = int(gain.argmax())
                best = max(best, (float(gain[at]), f, at), key=lambda b: b[0])
        if best[1] is None:
            return round(float(rate * g / (h + 1)), 6)
        _, f, at = best
        left = x[rows, f] <= at
        return (f, at, self._grow(x, grad, hess, rows[left], depth - 1, rate), self._grow(x, grad, hess, rows[~left], depth - 1, rate))

    def _values(self, tree, x) -> np.ndarray:
        if not isinstance(tree, tuple):
            return np.full(len(x), tree)
        f, at, low, high = tree
        return np.where(x[:, f] <= at, self._values(low, x), self._values(high, x))

    def scores(self, x: np.ndarray) -> np.ndarray:
        return self.base + sum(self._values(t, x) for t in self.trees)

    def sql(self, row: str) -> str:
        def case(tree) -> str:
            if not isinstance(tree, tuple):
                return f"{tree}D"
            f, at, low, high = tree
            return f"CASE WHEN {row}.{FEATURES[f]} <= {at} THEN {case(low)} ELSE {case(high)} END"

        return " + ".join([f"{round(self.base, 6)}D", *map(case, self.trees)])


def train(found: DataFrame, precision: float = PRECISION) -> tuple[Trees, list[float]] | None:
    """Trees and per-kind thresholds from all candidates that no base check accepts by itself."""
    fields = ", ".join(f"'{f}', x.{f}" for f in FEATURES)
    hit = f"exists({_touched('bases[x.kind]')}, b -> (b.start <= x.start AND x.end <= b.end) OR (x.start <= b.start AND b.end <= x.end))"
    against = "x.prev IN (2, 3) OR x.next IN (2, 3) OR x.valid = 0 OR x.date OR x.cue = 2"
    label = f"CASE WHEN {hit} THEN 0 WHEN {against} THEN 1 WHEN x.cue = 1 THEN 3 ELSE 2 END"  # personal, something else, unknown, hinted at
    each = _bound("bases", _BY_KIND, f"transform(filter(c, x -> NOT x.ok), x -> named_struct({fields}, 'label', {label}))")
    seen = found.select(F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS)).alias("fold"), F.explode(F.expr(each)).alias("x")).select("fold", "x.*").where("label < 3")
    held = F.col("fold") == 0
    sums = [F.sum((F.col("label") == i).cast("int") * cond.cast("int")).alias(f"n{i}{name}") for i in range(3) for name, cond in (("fit", ~held), ("held", held))]
    cells = seen.groupBy(*FEATURES).agg(*sums).collect()
    x = np.array([[r[f] for f in FEATURES] for r in cells], np.int64).reshape(-1, len(FEATURES))
    order = np.lexsort(x.T)
    count = {name: np.array([r[name] for r in cells], float)[order] if len(cells) else np.zeros(0) for name in (f"n{i}{p}" for i in range(3) for p in ("fit", "held"))}
    x = x[order]
    pos, neg = ({p: count[f"n0{p}"] for p in ("fit", "held")}, {p: count[f"n1{p}"] + UNKNOWN * count[f"n2{p}"] for p in ("fit", "held")})
    if not pos["fit"].sum() or not neg["fit"].sum():
        return None
    trees = Trees(x, pos["fit"], neg["fit"])
    score, limits = trees.scores(x), []
    for k in range(len(KINDS)):
        mine = np.flatnonzero(x[:, 0] == k)
        mine = mine[np.argsort(-score[mine], kind="stable")]
        right, total = np.cumsum(pos["held"][mine]), np.cumsum(pos["held"][mine] + neg["held"][mine])
        last = np.append(np.diff(score[mine]) != 0, True) if len(mine) else np.zeros(0, bool)  # cells of one score go together
        good = np.flatnonzero(last & (right >= precision * total) & (right >= LEAST_HELD) & (score[mine] > 0))
        if not len(good):
            limits.append(float("inf"))
            continue
        least = float(score[mine[good[-1]]])  # the limit lies between it and the next lower score, as SQL rounds
        limits.append((least + max([least - 0.1, *(float(s) for s in score[mine] if s < least)])) / 2)
    return trees, limits


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", precision: float = PRECISION) -> DataFrame:
    """One row per row of `docs`: doc_id, base counts per kind, base_sha256, all spans as kind:start:end, and n_added."""
    found = saved(candidates(docs, id_col, text_col), "candidates")
    learned = train(found, precision)
    base = "array_sort(transform(base, x -> named_struct('start', x.start, 'kind', x.kind, 'end', x.end)))"
    if learned:
        trees, limits = learned
        limit = "CASE x.kind " + " ".join(f"WHEN {k} THEN {'1e300' if v == float('inf') else repr(v)}D" for k, v in enumerate(limits)) + " END"
        better = "named_struct('a', b.over, 'b', b.end - b.start, 'c', -b.start, 'd', -b.kind) > named_struct('a', x.over, 'b', x.end - x.start, 'c', -x.start, 'd', -x.kind)"
        scored = f"transform(filter(c, x -> NOT x.ok), x -> named_struct('gen', x.gen, 'kind', x.kind, 'start', x.start, 'end', x.end, 'over', ({trees.sql('x')}) - ({limit})))"
        apart = _bound("bases", _BY_KIND, f"filter(filter({scored}, x -> x.over >= 0), x -> NOT exists(bases, l -> size({_touched('l')}) > 0))")
        rivals = f"transform(sequence(0, {len(BASE) + len(LOOSE) - 1}), g -> filter(good, y -> y.gen = g))"
        best = f"filter(good, x -> NOT exists(rivals, l -> exists({_touched('l')}, b -> {better})))"
        rest = _bound("good", apart, _bound("rivals", rivals, f"array_distinct(transform({best}, x -> named_struct('start', x.start, 'kind', x.kind, 'end', x.end)))"))
    else:
        rest = "cast(array() AS array<struct<start:int,kind:int,end:int>>)"
    spans = found.select("doc_id", F.expr(_bound("base", "filter(c, x -> x.ok)", f"named_struct('base', {base}, 'rest', {rest})")).alias("s")).select("doc_id", "s.base", "s.rest")
    names = "array(" + ", ".join(f"'{k}'" for k in KINDS) + ")"

    def text(spans: str) -> str:
        return f"array_join(transform({spans}, x -> concat({names}[x.kind], ':', x.start, ':', x.end)), ',')"

    return spans.select(
        "doc_id",
        *(F.expr(f"cast(size(filter(base, x -> x.kind = {i})) AS bigint)").alias(f"n_{k}") for i, k in enumerate(KINDS)),
        F.sha2(F.expr(text("base")), 256).alias("base_sha256"),
        F.expr(text("array_sort(concat(base, rest))")).alias("spans"),
        F.expr("cast(size(rest) AS bigint)").alias("n_added"),
    )
