"""Labels and prose: keys, classification, containment."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from footings.functions.money import TABLE_MONEY, strip


def slug(name: Column) -> Column:
    """File name → id: extension dropped, runs of other characters become one hyphen."""
    base = F.regexp_replace(F.lower(name), r"\.(pdf|xlsx|docx|zip)$", "")
    return F.btrim(F.regexp_replace(base, r"[^a-z0-9]+", "-"), F.lit("-"))


def norm_key(text: Column) -> Column:
    """Comparison key: lower-case letters and digits only."""
    return F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^a-z0-9]+", "")


def norm_header(text: Column) -> Column:
    """Worksheet heading → column name."""
    return F.btrim(F.regexp_replace(strip(text), r"\W+", "_"), F.lit("_"))


def title_key(filename: Column) -> Column:
    """Edition key: the file name without extension, letters and digits only."""
    return norm_key(F.regexp_replace(F.lower(filename), r"\.pdf$", ""))


# At most one pair of neighbours differs.
DOUBLED = r"^(?:(.)\1)*(?:..)?(?:(.)\2)*.?$"


def looks_doubled(text: Column) -> Column:
    """True when nearly every character was printed twice (at least eight of them)."""
    letters = F.regexp_replace(text, r"[^\p{L}\p{N}]", "")
    return (F.length(letters) >= 8) & letters.rlike(DOUBLED)


def strip_footer(line: Column) -> Column:
    """Drop a page number from the end of a line, but only where the line carries money."""
    return F.when(line.rlike(TABLE_MONEY), F.regexp_replace(line, r"\s+\d{1,4}$", "")).otherwise(line)


def canon_prefix(raw: Column, canon: dict[str, str]) -> Column:
    """Canonical name by prefix after cleaning spaces and a trailing dash; else null."""
    text = F.lower(F.regexp_replace(strip(F.regexp_replace(raw, r"\s*-\s*$", "")), r"\s+", " "))
    return F.coalesce(*[F.when(text.startswith(prefix), name) for prefix, name in canon.items()])


def classify_first(col: Column, rules: list[tuple[str, str]], default: str | None = None) -> Column:
    """Ordered (pattern, label) rules; the first that occurs in the text wins."""
    hit = F.coalesce(*[F.when(col.rlike(pattern), F.lit(label)) for pattern, label in rules])
    return hit if default is None else F.coalesce(hit, F.lit(default))


def destination(account: Column, numbers: dict[str, str], named: list[tuple[str, str]],
                unknown: str = "Unidentified") -> Column:
    """Where a transfer account sends money: by fund number, then by name, with the reason."""
    number = F.regexp_extract(account, r"(?i)FUND\s+(\d{2,3})", 1)
    by_number = F.coalesce(*[F.when(number == n, name) for n, name in numbers.items()])
    by_name = classify_first(account, named)
    how = (F.when(by_number.isNotNull(), F.concat(F.lit("fund number "), number))
           .when(by_name.isNotNull(), "named in the account")
           .otherwise("the account name does not say"))
    return F.struct(F.coalesce(by_number, by_name, F.lit(unknown)).alias("to_fund"),
                    how.alias("resolved_by"))


def tokens(text: Column, abbreviations: list[tuple[str, str]], stop: list[str]) -> Column:
    """Distinct words of two letters or more, abbreviations expanded, stop words dropped."""
    full = reduce(lambda t, rule: F.regexp_replace(t, rule[0], rule[1]), abbreviations,
                  F.lower(F.coalesce(text, F.lit(""))))
    words = F.array_distinct(F.regexp_extract_all(full, F.lit(r"[a-z0-9]+"), F.lit(0)))
    stops = F.array(*[F.lit(w) for w in stop]) if stop else F.array().cast("array<string>")
    return F.filter(F.array_except(words, stops), lambda w: F.length(w) > 1)


def flow_of(group: Column, line: Column) -> Column:
    """Money in, money out or financing, from the words it is printed under."""
    probe = F.lower(F.concat_ws(" ", group, line))
    # Keyword → flow, in order; a label naming both words is Revenue.
    return (F.when(probe.contains("revenue"), "Revenue")
            .when(probe.contains("expenditure") | probe.contains("expense"), "Expenditure")
            .when(probe.contains("financing"), "Other Financing")
            .otherwise("(unstated)"))


def collapse_spaces(text: Column) -> Column:
    """One line of prose: every run of white space becomes one blank."""
    return strip(F.regexp_replace(text, r"\s+", " "))


def verbatim(text: Column, quote: Column, exact: bool = True) -> Column:
    """Does the text contain the quotation, exactly or with white space collapsed?"""
    return text.contains(quote) if exact else collapse_spaces(text).contains(collapse_spaces(quote))
