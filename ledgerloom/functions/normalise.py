"""Scalar rules of the filings model as Column expressions (SCL-*). All run inside code generation."""

from __future__ import annotations


from pyspark.sql import Column
from pyspark.sql import functions as F

#: Filings from this date on report whole dollars, earlier ones thousands.
USD_SINCE = "2023-01-03"
UNKNOWN_AMENDMENT = "UNKNOWN_AMENDMENT_TYPE"
KNOWN_AMENDMENTS = ("RESTATEMENT", "NEW HOLDINGS")
TEMPLATE_VERSION = "periodic-chunk-v1"


def collapse(text: Column) -> Column:
    """Runs of (Unicode) white space become one space; ends are trimmed (SCL-28)."""
    return F.trim(F.regexp_replace(text, r"(?U)[\s\x1c-\x1f]+", " "))


def present(text: Column) -> Column:
    """Trimmed text, null where blank."""
    return F.nullif(F.regexp_replace(text, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", ""), F.lit(""))


def first_present(*texts: Column) -> Column:
    """The first that is not blank (SCL-17)."""
    return F.coalesce(*map(present, texts))


#: Lower-case letters that full case folding changes further, by the rule of the language's own table.
FOLDS = {c: c.casefold() for c in map(chr, range(0x80, 0x10000)) if c.lower() == c != c.casefold()}


def folded(text: Column) -> Column:
    """Full case folding, for comparing names: lower case, and further where a text holds letters that it changes."""
    low = F.lower(text)
    table = F.create_map(*(F.lit(x) for pair in FOLDS.items() for x in pair))
    each = F.transform(F.split(low, ""), lambda c: F.coalesce(F.try_element_at(table, c), c))
    return F.when(low.rlike(f"[{''.join(FOLDS)}]"), F.array_join(each, "")).otherwise(low)


def security_key(issuer: Column, title: Column, cusip: Column, figi: Column) -> Column:
    """SHA-256 over folded, collapsed names and upper-case identifiers (SCL-10)."""
    names = [folded(collapse(F.coalesce(c, F.lit("")))) for c in (issuer, title)]
    ids = [F.upper(F.trim(F.coalesce(c, F.lit("")))) for c in (cusip, figi)]
    return F.sha2(F.concat_ws("|", *names, *ids), 256)


def value_unit(filed: Column) -> Column:
    return F.when(filed >= F.lit(USD_SINCE).cast("date"), "USD").otherwise("THOUSANDS_USD")


def value_in_usd(value: Column, filed: Column) -> Column:
    """Reported value in dollars, by the filing date (SCL-11)."""
    return F.when(filed >= F.lit(USD_SINCE).cast("date"), value).otherwise(value * 1000)


def amendment_code(raw: Column, is_amendment: Column) -> Column:
    """Null for originals, a known code, or the unknown one (SCL-12)."""
    tidy = F.upper(collapse(raw))
    return F.when(~is_amendment, F.lit(None)).when(tidy.isin(*KNOWN_AMENDMENTS), tidy).otherwise(UNKNOWN_AMENDMENT)


def is_notice(form: Column) -> Column:
    return F.startswith(F.upper(form), F.lit("13F-NT"))


def is_amended(form: Column, flag: Column) -> Column:
    """By the form's suffix or the cover page's flag (SCL-13)."""
    return F.endswith(F.upper(form), F.lit("/A")) | F.coalesce(flag, F.lit(False))


def parsed_date(text: Column) -> Column:
    """ISO, US with dashes or slashes, or compact dates; else null (SCL-14)."""
    tidy = F.trim(text)
    forms = ((r"^\d{4}-\d{2}-\d{2}$", "yyyy-MM-dd"), (r"^\d{2}-\d{2}-\d{4}$", "MM-dd-yyyy"), (r"^\d{2}/\d{2}/\d{4}$", "MM/dd/yyyy"), (r"^\d{8}$", "yyyyMMdd"))
    return F.coalesce(*(F.when(tidy.rlike(p), F.try_to_timestamp(tidy, F.lit(f)).cast("date")) for p, f in forms))


def index_date(text: Column) -> Column:
    """The two date forms of filing indexes."""
    tidy = F.trim(text)
    return F.coalesce(*(F.when(tidy.rlike(p), F.try_to_timestamp(tidy, F.lit(f)).cast("date")) for p, f in ((r"^\d{4}-\d{2}-\d{2}$", "yyyy-MM-dd"), (r"^\d{8}$", "yyyyMMdd"))))


def parsed_bool(text: Column) -> Column:
    """True, false or null where neither is meant (SCL-15)."""
    tidy = F.lower(F.trim(text))
    return F.when(tidy.isin("true", "y", "yes", "1"), True).when(tidy.isin("false", "n", "no", "0"), False)


def parsed_decimal(text: Column, kind: str = "decimal(20,2)") -> Column:
    """Null where not a plain number; separators are not accepted (SCL-16)."""
    return F.trim(text).try_cast(kind)


def parsed_int(text: Column) -> Column:
    return F.trim(text).try_cast("int")


def tidy_cik(cik: Column) -> Column:
    """Without leading zeros; all zeros are one zero (SCL-21)."""
    bare = F.trim(cik)
    return F.when(bare.rlike("^0+$"), "0").otherwise(F.ltrim(bare, F.lit("0")))


def split_concept(concept: Column) -> tuple[Column, Column]:
    """Prefix (null without one) and local name (SCL-19)."""
    at = F.instr(concept, ":")
    return F.when(at > 0, F.left(concept, at - 1)), F.when(at > 0, F.substr(concept, at + 1)).otherwise(concept)


def primary_token(issuer: Column) -> Column:
    """First token of the upper-case name; null if the name begins with punctuation (SCL-06)."""
    return F.nullif(F.split_part(F.regexp_replace(F.upper(F.trim(issuer)), "[^A-Z0-9]+", " "), F.lit(" "), F.lit(1)), F.lit(""))


def identifier(figi: Column, cusip: Column) -> Column:
    return F.coalesce(F.nullif(figi, F.lit("")), F.nullif(cusip, F.lit("")))


def safe_filename(name: Column) -> Column:
    return F.regexp_replace(name, "[^A-Za-z0-9._-]+", "_")


def embedding_input(company: Column, cik: Column, ticker: Column, form: Column, filed: Column, period: Column, accession: Column, section: Column, title: Column, item: Column, ordinal: Column, text: Column) -> Column:
    """The text that is embedded for a chunk; unknown parts say so (SCL-23)."""

    def known(c: Column, other: str = "unknown") -> Column:
        return F.coalesce(F.nullif(c.cast("string"), F.lit("")), F.lit(other))

    def plain(c: Column) -> Column:
        return F.coalesce(c.cast("string"), F.lit("None"))

    lines = [
        F.concat(F.lit("Company: "), plain(company)),
        F.concat(F.lit("CIK: "), plain(cik)),
        F.concat(F.lit("Ticker: "), known(ticker)),
        F.concat(F.lit("Form: "), plain(form)),
        F.concat(F.lit("Filed date: "), known(filed)),
        F.concat(F.lit("Report period: "), known(period)),
        F.concat(F.lit("Accession: "), plain(accession)),
        F.concat(F.lit("Section: "), plain(section), F.lit(" - "), plain(title)),
        F.concat(F.lit("Item: "), known(item)),
        F.concat(F.lit("Chunk ordinal: "), plain(ordinal)),
        F.lit(""),
        plain(text),
    ]
    return F.concat_ws("\n", *lines)


def embedding_input_hash(text: Column) -> Column:
    return F.sha2(F.concat(F.lit(TEMPLATE_VERSION + "\n"), text), 256)


def vector_literal(vector: Column) -> Column:
    """[a,b,...] (SCL-25)."""
    return F.concat(F.lit("["), F.array_join(F.transform(vector, lambda x: x.cast("string")), ","), F.lit("]"))
