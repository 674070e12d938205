"""Mixing sources to target weights by hierarchical budgeting.

Leaves are (domain, language, source) triples. A token budget is propagated
down the tree by weights; a node whose documents cannot supply its share (at
`max_epochs` repetitions) is filled, and what it lacks goes to its siblings
first and to the siblings of its ancestors only when they are full as well.
Each leaf takes a prefix of the token stream of its seeded epochs: whole
epochs, then the beginning of one more, in an order drawn anew per epoch. The
document that reaches the budget counts with the tokens still wanted.

The order is a hash of id and text. One pass over the texts counts tokens and
writes slim rows (leaf, hash, tokens); everything is planned on those. Where a
leaf's prefix ends is found by descent: each round sums the tokens of 256
ranges of the hash a leaf, and goes on inside the range in which the prefix
ends, until that has RANGE_DOCS documents at most or the hash has no more
bits, so no leaf is ever gathered in one task, whatever its size. A last pass
over the texts takes what lies before the end. What is broadcast has one row
per leaf, and the leaves are bounded: sources, languages and domains that the
plan does not name share a leaf named `other`.

Defined cases: null or unnamed domains, languages and sources count as
`other`; a null text has no tokens. Documents without tokens are taken where
their place in the order lies inside the prefix. Ties of the order (repeated
rows) are broken by tokens, equal rows staying interchangeable. An
empty table, or a budget of zero, gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from .common import saved
from .wordcode import ANY

OTHER = "other"
#: Documents that the range in which a prefix ends holds at most before it is sorted, and bits of the order that a round looks at.
RANGE_DOCS, BITS = 4096, 8


@dataclass(frozen=True)
class Plan:
    """Weights of the children of the root, of any domain, and of any language; unnamed ones have the weight of `other`."""

    domains: dict[str, float]
    languages: dict[str, float]
    sources: dict[str, float]
    max_epochs: int = 4
    seed: int = 17
    overrides: dict[tuple[str, str], float] = field(default_factory=dict)

    def weight(self, path: tuple[str, ...]) -> float:
        level = (self.domains, self.languages, self.sources)[len(path) - 1]
        return self.overrides.get(path[:2], level.get(path[-1], level.get(OTHER, 1.0))) if len(path) == 2 else level.get(path[-1], level.get(OTHER, 1.0))


def share(budget: int, weights: list[float], capacities: list[int]) -> list[int]:
    """Split whole tokens by weight; full ones keep their capacity and the rest goes on to the others."""
    out, open_ = [0] * len(weights), [i for i in range(len(weights)) if capacities[i] > 0]
    left = min(budget, sum(capacities))
    while left > 0 and open_:
        total = sum(weights[i] for i in open_)
        wanted = {i: left * (weights[i] / total if total > 0 else 1 / len(open_)) for i in open_}
        full = [i for i in open_ if wanted[i] >= capacities[i] - out[i]]
        if not full:
            for i in open_:
                out[i] += int(wanted[i])
            rest = left - sum(int(wanted[i]) for i in open_)
            for i in sorted(open_, key=lambda i: (int(wanted[i]) - wanted[i], i))[:rest]:
                out[i] += 1
            return out
        for i in full:
            left -= capacities[i] - out[i]
            out[i] = capacities[i]
        open_ = [i for i in open_ if i not in full]
    return out


def budgets(supply: dict[tuple[str, str, str], int], plan: Plan, budget: int) -> dict[tuple[str, str, str], int]:
    """Tokens for each leaf, given the tokens that each leaf's documents have."""
    room = {leaf: tokens * plan.max_epochs for leaf, tokens in supply.items()}
    out: dict[tuple[str, str, str], int] = {}

    def down(prefix: tuple[str, ...], tokens: int) -> None:
        if len(prefix) == 3:
            out[prefix] = tokens
            return
        below = sorted({leaf[: len(prefix) + 1] for leaf in room if leaf[: len(prefix)] == prefix})
        holds = [sum(n for leaf, n in room.items() if leaf[: len(child)] == child) for child in below]
        for child, part in zip(below, share(tokens, [plan.weight(c) for c in below], holds), strict=True):
            down(child, part)

    down((), budget)
    return out


@F.arrow_udf(LongType())
def token_count(text: pa.Array) -> pa.Array:
    """Runs of characters other than ASCII white space; none in a null."""
    text = text.fill_null("")
    ends = np.frombuffer(text.buffers()[1], np.int32)[text.offset : text.offset + len(text) + 1] if len(text) else np.zeros(1, np.int32)
    raw = np.frombuffer(text.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
    begins = ANY[raw]
    begins[1:] &= ~begins[:-1]
    at = (ends[:-1] - ends[0])[np.diff(ends) > 0]
    begins[at] = ANY[raw[at]]  # what stands before is another text's
    return pa.array(np.diff(np.searchsorted(np.flatnonzero(begins), ends - ends[0])))


def _named(column: Column, names: dict[str, float]) -> Column:
    return F.when(column.isin(*names), column).otherwise(F.lit(OTHER)) if names else F.lit(OTHER)


def mix(docs: DataFrame, plan: Plan, domain: Column, budget_share: float = 1.0, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """`docs` under the names c0, c1, ... with domain, lang, source (as leaves), n_tokens, epoch and taken, one row for each time a document is taken.

    The budget is `budget_share` times the tokens of `docs`. `domain` is an expression over the columns of `docs`.
    """
    spark, names, leaf = docs.sparkSession, docs.columns, ["_domain", "_lang", "_source"]
    kinds = [_named(domain, plan.domains), _named(F.col(lang_col), plan.languages), _named(F.col(source_col), plan.sources)]
    here = [*(c.alias(n) for c, n in zip(kinds, leaf, strict=True)), F.xxhash64(id_col, text_col).alias("_key")]
    slim = saved(docs.select(*here, token_count(text_col).alias("_n")), "mixture")

    totals = slim.groupBy(*leaf).agg(F.sum("_n").alias("tokens"), F.count("*").alias("docs")).collect()
    supply = {(r["_domain"], r["_lang"], r["_source"]): r["tokens"] for r in totals}
    wanted = budgets(supply, plan, int(budget_share * sum(supply.values())))
    parts = {k: divmod(wanted[k], n) for k, n in supply.items() if n}
    ends = _ends(slim, leaf, parts, plan.seed, max((r["docs"] for r in totals), default=0))
    last = [(*k, whole, rest, *ends.get(k, (None, 0, 0))) for k, (whole, rest) in parts.items()]
    table = spark.createDataFrame(last, "domain string, lang string, source string, whole long, rest long, end long, before long, ties long")

    known = docs.select(*(F.col(n).alias(f"c{i}") for i, n in enumerate(names)), *here)
    drawn = _placed(known, leaf, table, plan.seed).where((F.col("whole") > 0) | (F.col("_at") <= F.col("end")))
    drawn = drawn.withColumn("_n", token_count(f"c{names.index(text_col)}"))
    left = F.col("rest") - F.col("before")
    part = F.when(F.col("_at") < F.col("end"), F.col("_n")).when(F.col("_at") == F.col("end"), F.least("_n", left)).otherwise(-1)
    if any(e[2] > 1 for e in ends.values()):
        tied = drawn.where("_at = end")
        order = Window.partitionBy(*leaf).orderBy("_n").rowsBetween(Window.unboundedPreceding, 0)
        tied = tied.withColumn("_part", F.least("_n", left - F.sum("_n").over(order) + F.col("_n")))
        both = drawn.where("end IS NULL OR _at != end").withColumn("_part", F.coalesce(part, F.lit(-1))).unionByName(tied)
    else:
        both = drawn.withColumn("_part", F.coalesce(part, F.lit(-1)))
    both = both.withColumn("_more", ((F.col("_part") > 0) | ((F.col("_part") == 0) & (F.col("_n") == 0))).cast("long"))
    times = F.filter(F.sequence(F.lit(0).cast("long"), F.col("whole")), lambda e: (e < F.col("whole")) | (F.col("_more") == 1))
    return both.withColumn("epoch", F.explode(times)).select(
        *(f"c{i}" for i in range(len(names))),
        F.col("_domain").alias("domain"),
        F.col("_lang").alias("lang"),
        F.col("_source").alias("source"),
        F.col("_n").alias("n_tokens"),
        "epoch",
        F.when(F.col("epoch") < F.col("whole"), F.col("_n")).otherwise(F.col("_part")).alias("taken"),
    )


def _placed(rows: DataFrame, leaf: list[str], table: DataFrame, seed: int) -> DataFrame:
    """`rows` with their leaf's row of `table` and their place `_at` in the leaf's last epoch."""
    same = [F.col(a) == F.col(b) for a, b in zip(leaf, ("domain", "lang", "source"), strict=True)]
    return rows.join(F.broadcast(table), same).withColumn("_at", F.xxhash64("_key", F.lit(seed), F.col("whole")))


def _ends(slim: DataFrame, leaf: list[str], parts: dict[tuple, tuple[int, int]], seed: int, docs: int) -> dict[tuple, tuple[int, int, int]]:
    """For each leaf that has a part of an epoch: the place where that ends, the tokens before it, and how many rows share it.

    `docs` are those of the largest leaf. The driver gets 2**BITS rows a leaf and round.
    """
    spark, bits = slim.sparkSession, 0
    open_ = {k: (0, 0) for k, (_, rest) in parts.items() if rest}  # the range looked at, and the tokens before it

    def inside() -> DataFrame:
        rows = [(*k, *parts[k], at, before) for k, (at, before) in open_.items()]
        table = spark.createDataFrame(rows, "domain string, lang string, source string, whole long, rest long, range long, before long")
        found = _placed(slim, leaf, table, seed)
        return found.where(F.shiftright("_at", 64 - bits) == F.col("range")) if bits else found

    while open_ and docs > RANGE_DOCS and bits < 64:
        docs, found = 0, {}
        for r in inside().groupBy(*leaf, F.shiftright("_at", 64 - bits - BITS).alias("child")).agg(F.sum("_n").alias("n"), F.count("*").alias("docs")).collect():
            found.setdefault(tuple(r[n] for n in leaf), []).append((r["child"], r["n"], r["docs"]))
        for k, children in found.items():
            before = open_[k][1]
            for child, n, held in sorted(children):
                if before + n >= parts[k][1]:
                    open_[k], docs = (child, before), max(docs, held)
                    break
                before += n
        bits += BITS
    if not open_:
        return {}
    places = inside().groupBy(*leaf, "rest", "before", "_at").agg(F.sum("_n").alias("n"), F.count("*").alias("ties"))
    upto = F.col("before") + F.sum("n").over(Window.partitionBy(*leaf).orderBy("_at").rowsBetween(Window.unboundedPreceding, 0))
    ends = places.withColumn("upto", upto).where("upto - n < rest AND rest <= upto").collect()
    return {tuple(r[n] for n in leaf): (r["_at"], r["upto"] - r["n"], r["ties"]) for r in ends}
