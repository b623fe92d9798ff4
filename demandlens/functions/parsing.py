"""Column expressions that turn raw strings into typed values.

All of them are built-in Catalyst expressions (codegen, no Python per row)
and are ANSI-safe: only ``try_*`` conversions, never a plain ``cast``.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accounting negatives "(1234)" become "-1234"; a fraction is
# truncated toward zero the way a non-ANSI string->long cast does.
_OPEN_PAREN = r"^\("
_CLOSE_PAREN = r"\)$"
_FRACTION = r"^([+-]?)(\d*)\.\d*$"
_FRACTION_REPLACEMENT = "$10$2"


def normalise_key(c: Column) -> Column:
    """Trim blanks and upper-case a categorical key."""
    return F.upper(F.trim(c))


def accounting_text(c: Column) -> Column:
    """Trimmed demand text with "(" -> "-" and a closing ")" removed; the two
    rewrites are independent, as in the source data's convention."""
    return F.regexp_replace(
        F.regexp_replace(F.trim(c), _OPEN_PAREN, "-"), _CLOSE_PAREN, ""
    )


def demand_to_long(c: Column) -> Column:
    """Raw demand string -> bigint, NULL when it is not an integer literal
    (after fraction truncation). `1e3` and `1,234` are NULL."""
    text = F.regexp_replace(accounting_text(c), _FRACTION, _FRACTION_REPLACEMENT)
    return text.try_cast("bigint")


def legacy_tolerant(fmt: str) -> str:
    """Java pattern that also accepts one-digit month/day (``MM`` -> ``M``,
    ``dd`` -> ``d``, runs of exactly two letters; month names keep theirs).
    Under the CORRECTED parser a single letter takes one or two digits."""
    if re.search(r"[yMd]{8}", fmt):
        return fmt  # no separators: the widths tell the fields apart
    return re.sub(r"(?<!M)MM(?!M)", "M", re.sub(r"(?<!d)dd(?!d)", "d", fmt))


def format_shape(fmt: str) -> str | None:
    """Regex of the text a numeric date pattern can match (``yyyy`` ->
    4 digits, ``M``/``d`` -> 1-2 digits); None when the pattern has other
    letters (then no pre-check is made)."""
    out, i = ["^"], 0
    while i < len(fmt):
        ch = fmt[i]
        j = i
        while j < len(fmt) and fmt[j] == ch:
            j += 1
        run = j - i
        if ch == "y":
            out.append(r"\d{%d}" % (4 if run != 2 else 2))
        elif ch in "Md" and run <= 2:
            out.append(r"\d{1,2}")
        elif ch.isalpha() or ch == "'":
            return None
        else:
            out.append(re.escape(fmt[i:j]))
        i = j
    out.append("$")
    return "".join(out)


def multi_format_date(c: Column, formats: Iterable[str], lenient: bool = True) -> Column:
    """First format that parses wins (coalesce in list order). Each attempt
    is guarded by a cheap shape match: a failed parse takes the slow
    exception path inside the parser, so text of another layout skips it."""
    trimmed = F.trim(c)
    attempts = []
    for f in formats:
        pattern = legacy_tolerant(f)
        # text after the date, such as a time of day, is cut off: as many
        # blank-separated words are kept as the layout has
        text = F.substring_index(trimmed, " ", pattern.count(" ") + 1) if lenient else trimmed
        parsed = F.try_to_date(text, pattern)
        shape = format_shape(pattern)
        attempts.append(F.when(text.rlike(shape), parsed) if shape else parsed)
    return F.coalesce(*attempts) if len(attempts) > 1 else attempts[0]


def failed_parse(parsed: Column, raw: Column) -> Column:
    """True when a non-null input did not convert."""
    return parsed.isNull() & raw.isNotNull()
