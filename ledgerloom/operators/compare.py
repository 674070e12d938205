"""Two-period comparison of portfolios in three matching passes (VIW-06).

Works on any number of filers at once. Positions match by security key, then
by a shared identifier, then by issuer and an equal share count with a value
within half of the larger one. The last two passes accept only candidates
that are the single one of both their sides. What is left is new or disposed.

After a pass, sides are cleared by filer, period and security key alone, so a
matched share position also clears its option sibling; `strict_keys` clears
by the full position key instead.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.normalise import identifier, primary_token

KEY = ["cik", "security_reference_key", "put_call_key", "shares_principal_type_key"]
#: What a position brings along, apart from KEY.
FIELDS = ["canonical_filer_name", "report_period", "issuer_name", "class_title", "cusip", "figi", "accession_number", "total_value_usd", "total_shares_principal_amount", "ident", "token"]
ALL, SHARES, OPTIONS = "all", "shares_only", "options_only"
MONEY = "decimal(38,2)"


def position_filter(which: str, put_call: str | None = None) -> Column:
    """Rows for a filter name; an unknown or null name selects none (FLT-06, FLT-07)."""
    kind = F.col("put_call_key")
    chosen = {ALL: F.lit(True), SHARES: kind == "NONE", OPTIONS: kind != "NONE"}.get(which, F.lit(False))
    return chosen if put_call is None else chosen & (kind == put_call.upper())


def with_provenance(positions: DataFrame, effective: DataFrame) -> DataFrame:
    """Positions with the accession number of the latest effective filing (JON-10)."""
    latest = effective.where("NOT is_notice").select("cik", "report_period", "accession_number")
    return positions.join(latest, ["cik", "report_period"], "left")


def _prepared(positions: DataFrame, side: str) -> DataFrame:
    return positions.select("*", identifier(F.col("figi"), F.col("cusip")).alias("ident"), primary_token(F.col("issuer_name")).alias("token"), F.lit(side).alias("side")).select("side", *KEY, *FIELDS)


def _single(pairs: DataFrame) -> DataFrame:
    """Pairs that are the only candidate of both their sides, counted by filer and key."""
    counts = (f"count(*) OVER (PARTITION BY {s}_cik, {s}_security_reference_key) AS _n{s}" for s in "cp")
    return pairs.selectExpr("*", *counts).where("_nc = 1 AND _np = 1").drop("_nc", "_np")


def _across(aggregate: str, of: str, what: str, by: str) -> str:
    """An aggregate of `what` over the other side's rows of a group, for rows of either side; `of` says which rows count."""
    each = (f"{aggregate}(CASE WHEN side = '{s}' AND {of} THEN {what} END) OVER (PARTITION BY {by})" for s in "pc")
    return "CASE WHEN side = 'c' THEN {} ELSE {} END".format(*each)


_NAMES = ", ".join([*KEY, *FIELDS])
_OWN = "side, cik, security_reference_key"
#: What makes two positions that are left one, beside equal kinds and share counts.
_NEAR = "abs({c}total_value_usd - {p}total_value_usd) <= greatest({c}total_value_usd, {p}total_value_usd) * 0.5 AND ({p}issuer_name = {c}issuer_name OR {p}token = {c}token)"


def paired_sql(source: str, strict_keys: bool = False) -> str:
    """Rows of both sides with what the first two passes make of them, by windows alone: `partner` of the other side, `strategy`, and `left` for the third pass."""
    group, known = "cik, put_call_key, shares_principal_type_key, ident", " AND ".join(f"{c} IS NOT NULL" for c in KEY)
    steps = [
        f"{_across('max', known, f'struct({_NAMES})', ', '.join(KEY))} AS _same",
        "_same IS NULL AND ident IS NOT NULL AS _open",
        f"CASE WHEN _open THEN {_across('count', '_open', '1', group)} ELSE 0 END AS _n",
        f"sum(_n) OVER (PARTITION BY {_OWN}) AS _total",
        # A row with one candidate in all, whose candidate has one in all, is half of a pair.
        f"{_across('max', '_open AND _total = 1', f'struct({_NAMES})', group)} AS _mate",
        "_open AND _n = 1 AND _total = 1 AND _mate IS NOT NULL AS _half",
    ]
    for step in steps:
        source = f"(SELECT *, {step} FROM {source})"
    cleared = "_half" if strict_keys else f"max(_half) OVER (PARTITION BY {_OWN})"
    return f"""SELECT side, {_NAMES}, CASE WHEN _same IS NOT NULL THEN _same WHEN _half THEN _mate END AS partner, CASE WHEN _same IS NOT NULL THEN 'exact_security_reference_key' WHEN _half THEN 'figi_or_cusip' END AS strategy,
        _same IS NULL AND NOT {cleared} AS left FROM {source}"""


def one_filer_sql(source: str, current_period: str, prior_period: str) -> str:
    """The comparison of one filer's sides as a single pass over `source`: candidates of the third pass are gathered by share count, which one filer's portfolio bounds."""
    group, live = "cik, put_call_key, shares_principal_type_key, total_shares_principal_amount", "left AND total_shares_principal_amount <> 0"
    near = _NEAR.format(c="", p="o.")

    def others(more: str = "") -> str:
        return f"CASE WHEN {live} THEN filter({_across('collect_list', live, f'struct({_NAMES}{more})', group)}, o -> {near}) END"

    steps = [f"{others()} AS _near", f"sum(coalesce(size(_near), 0)) OVER (PARTITION BY {_OWN}) AS _sum", f"{others(', _sum')} AS _again", "coalesce(size(_near) = 1 AND _sum = 1 AND _again[0]._sum = 1, false) AS _half", f"left AND NOT max(_half) OVER (PARTITION BY {_OWN}) AS _alone"]
    inner = f"({paired_sql(source)})"
    for step in steps:
        inner = f"(SELECT *, {step} FROM {inner})"
    mate = f"coalesce(partner, CASE WHEN _half THEN named_struct({', '.join(f'{chr(39)}{n}{chr(39)}, _near[0].{n}' for n in [*KEY, *FIELDS])}) END)"
    joined = f"(SELECT side, {_NAMES}, {mate} AS o, coalesce(strategy, CASE WHEN _half THEN 'issuer_or_primary_token_same_shares' END) AS strategy FROM {inner} WHERE _alone OR (side = 'c' AND (partner IS NOT NULL OR _half)))"

    def prior(name: str) -> str:
        return f"CASE WHEN side = 'p' THEN {name} ELSE o.{name} END"

    def first(name: str) -> str:
        return f"coalesce({name}, o.{name})" if name == "canonical_filer_name" else name

    row = _row(lambda n: f"CASE WHEN side = 'c' THEN {n} END", prior, first, current_period, prior_period, prior("security_reference_key"), "strategy IS NULL AND side = 'c'", "side = 'p'", "coalesce(strategy, CASE WHEN side = 'c' THEN 'new_position' ELSE 'disposed_position' END)")
    return f"SELECT {', '.join(row)} FROM {joined}"


def compare(current: DataFrame, prior: DataFrame, current_period: str, prior_period: str, strict_keys: bool = False, stage: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """Current against prior positions: one row per matched pair and per new or disposed position.

    Both have the columns of positions and accession_number, and a key once. `stage` may persist or write the
    table that the branches read. Each side is read once: both go through the first two passes as one table.
    """
    both = _prepared(current, "c").unionByName(_prepared(prior, "p"))
    rows = stage(both.sparkSession.sql(paired_sql("{both}", strict_keys), both=both))
    names = [*KEY, *FIELDS]
    early = rows.where("side = 'c' AND partner IS NOT NULL").selectExpr(*(f"{c} AS c_{c}" for c in names), *(f"partner.{c} AS p_{c}" for c in names), "strategy")
    left = rows.where("left")
    c, p = (left.where(f"side = '{s}' AND total_shares_principal_amount <> 0").selectExpr(*(f"{n} AS {s}_{n}" for n in names)) for s in "cp")
    same = [f"c_{n} = p_{n}" for n in ("cik", "put_call_key", "shares_principal_type_key", "total_shares_principal_amount")]
    renamed = _single(c.join(p, F.expr(" AND ".join([*same, _NEAR.format(c="c_", p="p_")]))))
    cleared = KEY if strict_keys else KEY[:2]
    gone = renamed.selectExpr("inline(array({}))".format(", ".join(f"struct('{s}' AS side, {', '.join(f'{s}_{n} AS {n}' for n in cleared)})" for s in "cp")))
    alone = left.join(gone, ["side", *cleared], "left_anti")
    pairs = early.unionByName(renamed.selectExpr("*", "'issuer_or_primary_token_same_shares' AS strategy"))
    return pairs.selectExpr(*_matched()).unionByName(alone.selectExpr(*_one_sided(current_period, prior_period)))


def _row(c: Callable[[str], str], p: Callable[[str], str], first: Callable[[str], str], now: str, before: str, previous_key: str, new: str, gone: str, strategy: str) -> list[str]:
    """The columns of the result, where `c`, `p` and `first` give a field of the current, the prior and the leading side."""
    out = {n: first(n) for n in ("cik", "canonical_filer_name")} | {"report_period": now, "previous_report_period": before, "security_reference_key": first("security_reference_key"), "previous_security_reference_key": previous_key, "issuer_name": first("issuer_name")}
    for n in ("class_title", "cusip", "figi"):
        out |= {n: first(n), f"previous_{n}": p(n)}
    out |= {"put_call": f"nullif({first('put_call_key')}, 'NONE')", "shares_principal_type": f"nullif({first('shares_principal_type_key')}, 'UNKNOWN')", "current_accession_number": c("accession_number"), "prior_accession_number": p("accession_number")}
    for amount, name, change in (("total_value_usd", "value_usd", "value_change_usd"), ("total_shares_principal_amount", "shares_principal_amount", "share_change")):
        had = [f"CAST(coalesce({s(amount)}, 0) AS {MONEY})" for s in (c, p)]
        out |= {f"current_{name}": had[0], f"prior_{name}": had[1], change: f"CAST({had[0]} - {had[1]} AS {MONEY})"}
    out |= {"new_position": new, "disposed_position": gone, "match_strategy": strategy}
    return [f"{value} AS {name}" for name, value in out.items()]


def _matched() -> list[str]:
    def first(name: str) -> str:
        return f"coalesce(c_{name}, p_{name})" if name == "canonical_filer_name" else f"c_{name}"

    return _row(lambda n: f"c_{n}", lambda n: f"p_{n}", first, "c_report_period", "p_report_period", "p_security_reference_key", "false", "false", "strategy")


def _one_sided(current_period: str, prior_period: str) -> list[str]:
    """New positions are on the current side alone, disposed ones on the prior side."""

    def of(side: str) -> Callable[[str], str]:
        return lambda n: f"CASE WHEN side = '{side}' THEN {n} END"

    periods = [f"CASE WHEN side = '{s}' THEN report_period ELSE DATE '{d}' END" for s, d in (("c", current_period), ("p", prior_period))]
    return _row(of("c"), of("p"), lambda n: n, *periods, of("p")("security_reference_key"), "side = 'c'", "side = 'p'", "CASE WHEN side = 'c' THEN 'new_position' ELSE 'disposed_position' END")


def compare_filer(positions: DataFrame, effective: DataFrame, cik: str, current: str, prior: str, which: str = ALL, put_call: str | None = None, strict_keys: bool = False) -> DataFrame:
    """One filer's portfolio at two report periods."""
    chosen = positions.where((F.col("cik") == cik) & position_filter(which, put_call))
    sides = [with_provenance(chosen.where(F.col("report_period") == F.lit(d).cast("date")), effective) for d in (current, prior)]
    return compare(*sides, current, prior, strict_keys)
