"""Printed amounts to numbers.  Unreadable text is null, never zero."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The shapes of a printed amount, as the documents print them.
MONEY_TEXT = r"^\(?\$?\s*(-?[\d,]+(?:\.\d+)?)\s*\)?%?$"
TABLE_MONEY = r"(?:\(\$[\d,]+\)|\$\(?[\d,]+\)?|–|—)"
TABLE_MONEY_RUN = r"^(.*?)\s*((?:" + TABLE_MONEY + r"\s*){2,})$"
SUFFIX_MONEY = r"^\$?\s*([\d,]+(?:\.\d+)?)\s*([kKmM])?\s*$"
RECOGNISED_NUMBER = r"\(?\$?\s?\d{1,3}(?:[, ]\d{3})+\)?|\(?\$?\s?\d{3,}\)?"
PAGE_FIGURE = r"\(?\$?\s?\d[\d,]{2,}\)?"
PAGE_FIGURE_SPACED = r"\(?\$?\s?\d[\d,\s]{2,}\)?"
PLAN_MONEY = r"\$\s*\(?-?([\d,]+)\)?"
GROUPED = r"^\d{1,3}(?:[, ]\d{3})+$"
SPACED_LIMIT = 1e9
BLANKS = ["-", "–", "—", ""]
WHITE = " \t\n\r\f\x0b\u00a0"


def strip(col: Column) -> Column:
    """Trim every kind of white space, not only blanks."""
    return F.btrim(col, F.lit(WHITE))


def let(value: Column, use) -> Column:
    """`use` of a value that is worked out once: inside a function over an array nothing else keeps it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _number(text: Column) -> Column:
    return F.regexp_replace(text, ",", "").try_cast("double")


def _signed(value: Column, negative: Column) -> Column:
    return F.when(negative, -value).otherwise(value)


def parse_money(col: Column) -> Column:
    """`$1,234`, `(1,234)` → −1234, `73%` → 73; blanks, `TBD` and malformed text → null."""
    text = strip(col)
    value = _number(F.regexp_extract(text, MONEY_TEXT, 1))
    return _signed(value, text.startswith("(") & text.endswith(")"))


def parse_money_table(col: Column) -> Column:
    """One appendix cell: a dash is the document's blank; either parenthesis is a minus."""
    digits = F.regexp_replace(col, r"[^\d.]", "")
    value = F.when(~col.isin("–", "—"), digits.try_cast("double"))
    return _signed(value, col.startswith("(") | col.endswith(")"))


def money_list(col: Column) -> Column:
    """Every appendix cell on a line, in printed order (nulls kept in place)."""
    return F.transform(F.regexp_extract_all(col, F.lit(TABLE_MONEY), F.lit(0)), parse_money_table)


def parse_number_prose(col: Column) -> Column:
    """A figure in prose: only the opening parenthesis is trusted as a minus."""
    text = strip(col)
    bare = F.btrim(text, F.lit("()%$ "))
    bare = strip(F.regexp_replace(bare, r"[$,]", ""))
    return _signed(bare.try_cast("double"), text.startswith("("))


def suffix_money(col: Column) -> Column:
    """`$791k`, `$2.916M` → dollars.  A comma-grouped figure with M is in thousands, noted."""
    text = strip(col)
    raw = F.regexp_extract(text, SUFFIX_MONEY, 1)
    suffix = F.lower(F.regexp_extract(text, SUFFIX_MONEY, 2))
    grouped = (suffix == "m") & raw.contains(",")
    scale = (F.when(grouped, 1000.0).when(suffix == "m", 1000000.0)
             .when(suffix == "k", 1000.0).otherwise(1.0))
    return F.struct(
        (_number(raw) * scale).alias("value"),
        F.when(grouped & raw.rlike(r"\d"), F.lit("comma-grouped figure with M read as thousands"))
        .alias("note"))


def clean_number(col: Column, strict: bool = False) -> Column:
    """A figure assembled from word boxes.

    Loose keeps any run of digits; strict also demands properly grouped thousands.
    """
    text = strip(col)
    bare = F.regexp_replace(F.btrim(text, F.lit("()")), r"[$ ]", "")
    if strict:
        ok = bare.rlike(r"^(?:\d{1,3}(?:,\d{3})*|\d+)$")
    else:
        ok = F.regexp_replace(bare, ",", "").rlike(r"^\d+$")
    value = F.when(~text.isin(*BLANKS) & ok, _number(bare))
    return _signed(value, text.startswith("(") | text.endswith(")"))


def parse_ocr_number(col: Column) -> Column:
    """A recognised figure: one space may stand for a comma, but not to build a billion."""
    def read(text: Column, bare: Column, joined: Column) -> Column:
        grouped = F.regexp_replace(bare, "[, ]", "").try_cast("double")
        merged = bare.contains(" ") & (grouped >= F.lit(SPACED_LIMIT))
        plain = F.when(joined.rlike(r"^(?:\d{1,3}(?:,\d{3})*|\d{3,})$"), _number(joined))
        value = F.when(bare.rlike(GROUPED), F.when(~merged, grouped)).otherwise(plain)
        return _signed(value, text.startswith("(") | text.endswith(")"))

    def inside(text: Column) -> Column:
        bare = strip(F.regexp_replace(F.btrim(text, F.lit("()")), r"\$", ""))
        return let(bare, lambda b: let(F.regexp_replace(b, " ", ""), lambda j: read(text, b, j)))

    return let(strip(col), inside)


def ocr_numbers(col: Column) -> Column:
    """All recognised figures of a line; a run that cannot be one figure is read piecewise."""
    tokens = F.regexp_extract_all(col, F.lit(RECOGNISED_NUMBER), F.lit(0))

    whole = F.transform(tokens, lambda t: F.struct(t.alias("t"), parse_ocr_number(t).alias("v")))

    def pieces(token):
        return F.filter(F.transform(F.split(strip(token), r"\s+"), parse_ocr_number), lambda v: v.isNotNull())

    return F.flatten(F.transform(whole, lambda x: F.when(x["v"].isNotNull(), F.array(x["v"]))
                                 .when(strip(x["t"]).contains(" "), pieces(x["t"]))
                                 .otherwise(F.array().cast("array<double>"))))


def figures_in(col: Column) -> Column:
    """Every money-looking figure of a text, signed, in reading order."""

    def read(token):
        bare = F.regexp_replace(token, r"[\s$]", "")
        return _signed(F.regexp_replace(bare, r"[(),]", "").try_cast("double"),
                       bare.startswith("("))

    return F.transform(F.regexp_extract_all(col, F.lit(PAGE_FIGURE), F.lit(0)), read)


def figure_tokens(col: Column) -> Column:
    """Canonical digit strings of a text: grouped properly, three digits or more."""

    def canonical(token):
        bare = F.regexp_replace(token, r"[$ ]", "")
        bare = strip(bare)
        body = F.btrim(bare, F.lit("()"))
        digits = F.regexp_replace(body, ",", "")
        ok = body.rlike(r"^(?:\d{1,3}(?:,\d{3})*|\d+)$") & (F.length(digits) >= 3)
        return F.when(ok, F.concat(F.when(bare.startswith("("), "-").otherwise(""), digits))

    tokens = F.regexp_extract_all(col, F.lit(PAGE_FIGURE_SPACED), F.lit(0))
    return F.array_compact(F.transform(tokens, canonical))


def money_row(col: Column) -> Column:
    """A plan-table line: the label before the first figure, and the figures."""
    def read(token):
        return _signed(F.regexp_replace(token, r"[^\d]", "").try_cast("double"),
                       token.rlike(r"^[$ ]*\("))

    def row(tokens):
        label = F.when(F.size(tokens) > 0, strip(F.regexp_extract(col, r"^(.*?)" + PLAN_MONEY, 1)))
        return F.struct(label.alias("label"), F.transform(tokens, read).alias("amounts"))

    return let(F.regexp_extract_all(col, F.lit(PLAN_MONEY), F.lit(0)), row)
