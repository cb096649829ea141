"""Values, names, units and quarters out of text, as column expressions."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

YEARS = (1990, 2069)
_WORDS = {"first": 1, "second": 2, "third": 3, "fourth": 4}
# Endings that a company's name may lose, in the order they are tried.
SUFFIXES = (" NATIONAL ASSOCIATION", " CORPORATION", " INCORPORATED", " HOLDINGS", " HOLDING", " COMPANY", " GROUP", " LLC", " INC", " CORP", " CO", " NA", " &")
SCALES = {"thousand": 1e3, "million": 1e6, "billion": 1e9}


def financial_number(text: Column) -> Column:
    """A printed amount: currency signs and commas dropped, parentheses negative; blanks, dashes
    and what is not a number are null."""
    flat = F.regexp_replace(F.trim(text), "[$,\\s—–]", "")
    negative = flat.rlike(r"^\(.*\)?$") | flat.rlike(r"^[^(]*\)$")
    bare = F.regexp_replace(flat, "[()]", "")
    value = F.when(bare.rlike(r"^-?([0-9]+\.?[0-9]*|\.[0-9]+)$"), bare.try_cast("double"))
    return F.when(negative, -value).otherwise(value)


def filed_value(raw: Column) -> Column:
    """A filed cell: blank, CONF, NR, NA and what is not a number are null."""
    clean = F.trim(raw)
    return F.when(~F.upper(clean).isin("", "CONF", "NR", "NA"), clean.try_cast("double"))


def employer_id(raw: Column) -> Column:
    """Nine digits, zeros in front; null where there is no digit or all are zero."""
    digits = F.regexp_replace(raw, "[^0-9]", "")
    return F.when((digits != "") & ~digits.rlike("^0+$"), F.lpad(digits, 9, "0"))


def company_name(name: Column) -> Column:
    """Upper case, signs to spaces, endings of the corporate form dropped one after the other."""
    squeeze = lambda c: F.trim(F.regexp_replace(c, r"\s+", " "))
    out = squeeze(F.translate(F.upper(name), ",./", "   "))
    for suffix in SUFFIXES:
        out = F.regexp_replace(out, re.escape(suffix) + "$", "")
    return squeeze(out)


def magnitude(variable: Column, value: Column, prefixes: tuple[str, ...] = ("loans_", "acl_", "nonaccrual_")) -> Column:
    """Balances are kept as magnitudes; other variables keep their sign."""
    return F.when(reduce(lambda a, b: a | b, (variable.startswith(p) for p in prefixes)), F.abs(value)).otherwise(value)


def declared_scale(text: Column) -> Column:
    """The unit that a caption states ("in millions"), as a factor; null if none."""
    word = F.regexp_extract(F.lower(text), r"\bin (thousand|million|billion)s?\b", 1)
    return reduce(lambda acc, kv: F.when(word == kv[0], kv[1]).otherwise(acc), SCALES.items(), F.lit(None).cast("double"))


def document_quarter(title: Column) -> Column:
    """A struct of year y and quarter q (project it once, then take its fields) that a document's title or file name states, else nulls: in words, nQyyyy,
    Qn yyyy, yyyyQn, yyyy nQ, nQyy, or an eight-digit date in a quarter's last month."""
    s = F.trim(F.regexp_replace(F.lower(title), r"[+_\-/\\.]+", " "))
    year, month = "((?:19|20)[0-9]{2})", "(0[1-9]|1[0-2])"
    forms = [
        (rf"(?s)\b(first|second|third|fourth) quarter\b.{{0,20}}?\b{year}\b", 2, 1),
        (rf"(?s)\b{year}\b.{{0,20}}?\b(first|second|third|fourth) quarter\b", 1, 2),
        (rf"(?<![0-9])([1-4])q ?{year}(?![0-9])", 2, 1),
        (rf"(?<!\w)q([1-4]) ?{year}(?![0-9])", 2, 1),
        (rf"(?<![0-9]){year} ?q([1-4])(?![0-9])", 1, 2),
        (rf"(?<![0-9]){year} ?([1-4])q(?!\w)", 1, 2),
        (r"(?<![0-9])([1-4])q([0-9]{2})(?![0-9])", 2, 1),
    ]
    found = []
    for i, (pattern, y, q) in enumerate(forms):
        at_year, at_q = F.regexp_extract(s, pattern, y), F.regexp_extract(s, pattern, q)
        y_col = F.when(at_year != "", at_year.cast("int") + (2000 if i == len(forms) - 1 else 0))
        q_col = reduce(lambda acc, kv, at_q=at_q: F.when(at_q == kv[0], kv[1]).otherwise(acc), _WORDS.items(), at_q.try_cast("int"))
        ok = y_col.between(*YEARS)
        found.append(F.when(ok, F.struct(y_col.alias("y"), q_col.alias("q"))))
    day = rf"(?<![0-9])(20[0-9]{{2}}){month}(0[1-9]|[12][0-9]|3[01])(?![0-9])"
    m = F.regexp_extract(s, day, 2).try_cast("int")
    found.append(F.when(m % 3 == 0, F.struct(F.regexp_extract(s, day, 1).cast("int").alias("y"), (m / 3).cast("int").alias("q"))))
    return F.coalesce(*found)


def label_and_value(cell: Column) -> tuple[Column, Column]:
    """(label, value) of a merged line: the text before the first number that is no footnote mark,
    and that number; null where it is a percentage or the whole line is one."""
    pattern = r"^(\D*?(?:\(\d{1,2}\)\D*?)*)\$? ?(?!\(\d{1,2}\))(\(?\d[\d,]*\.?\d*\)?)(?!\s?\s?%|[\d,.])"
    label, number = F.trim(F.regexp_extract(cell, pattern, 1)), F.regexp_extract(cell, pattern, 2)
    ok = (label != "") & (number != "")
    return F.when(ok, F.trim(F.regexp_replace(label, r"\(\d{1,2}\)|[$(]+$", ""))), F.when(ok, financial_number(number))
