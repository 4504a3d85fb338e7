"""Column builders: cleaning, parsing, bucketing and derived measures.

Every function takes and returns a ``Column`` and compiles to built-in
Catalyst expressions (no Python per row). Text parsing and the arithmetic on
parsed values are ANSI-safe: malformed or overflowing input becomes NULL
instead of failing the job.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from lamina.functions.exact import Measure

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- text -----------------------------------------------------------------

def clean_text(c: ColumnOrName) -> Column:
    """Strip leading/trailing spaces (spaces only; tabs and newlines stay)."""
    return F.trim(_c(c))


def clean_code(c: ColumnOrName) -> Column:
    """Trimmed, lower-cased code (e.g. a language code)."""
    return F.lower(F.trim(_c(c)))


def normalize_list(c: ColumnOrName, sep: str = ",") -> Column:
    """Trim, then rewrite any whitespace around ``sep`` as ``sep`` + one space."""
    plain = re.sub(r"([\\$])", r"\\\1", sep)  # these two are special in a replacement
    return F.regexp_replace(F.trim(_c(c)), rf"\s*{re.escape(sep)}\s*", f"{plain} ")


def first_item(c: ColumnOrName, sep: str = ",") -> Column:
    """First element of a delimited list, trimmed; NULL list stays NULL."""
    return F.trim(F.split(_c(c), re.escape(sep)).getItem(0))


# --- parsing --------------------------------------------------------------

def parse_digits(c: ColumnOrName) -> Column:
    """Integer made of the digits of a text ("$25,000,000" -> 25000000).

    Every non-digit is deleted, so a sign and a decimal point are lost
    ("-$5" -> 5, "$1.50" -> 150). Nothing left, or more digits than a BIGINT
    holds, gives NULL.
    """
    digits = F.regexp_replace(_c(c), r"[^0-9]", "")
    return F.when(digits != "", digits.try_cast("bigint"))


# Fixed value: an amount once everything but digits, points and signs is gone.
MONEY_SHAPE = r"^-?([0-9]+(\.[0-9]*)?|\.[0-9]+)$"


def parse_money(c: ColumnOrName) -> Column:
    """Amount of a text with its sign and decimals, as DECIMAL(38,6): "-$1,250.50" -> -1250.5.

    Unlike ``parse_digits`` nothing is guessed: a text that holds no single
    number (two points, a sign inside) or one of over 32 whole digits is NULL;
    decimals beyond the sixth are rounded.
    """
    plain = F.regexp_replace(_c(c), r"[^0-9.\-]", "")
    return F.when(plain.rlike(MONEY_SHAPE), plain.try_cast("decimal(38,6)"))


# Fixed value: shape a date text must have before it is parsed.
ISO_DATE_SHAPE = r"^\d{4}-\d{2}-\d{2}$"


def parse_iso_date(c: ColumnOrName) -> Column:
    """``yyyy-MM-dd`` text -> DATE; other shapes and impossible dates -> NULL."""
    col = _c(c)
    return F.when(col.rlike(ISO_DATE_SHAPE), F.try_to_date(col, "yyyy-MM-dd"))


def minutes(hours: ColumnOrName, mins: ColumnOrName) -> Column:
    """hours * 60 + minutes as INT; NULL when a part is NULL or the sum is no INT."""
    total = _c(hours).try_cast("decimal(20,0)") * 60 + _c(mins).try_cast("decimal(20,0)")
    return total.try_cast("int")


# The hour and minute markers of a duration text ("2h 22 min").
HOURS_PATTERN = r"(\d+)\s*h"
MINUTES_PATTERN = r"(\d+)\s*min"


def parse_duration(c: ColumnOrName) -> Column:
    """Duration text -> minutes. Both an hour and a minute part are required."""
    col = _c(c)
    h = F.regexp_extract(col, HOURS_PATTERN, 1)
    m = F.regexp_extract(col, MINUTES_PATTERN, 1)
    return F.when((h != "") & (m != ""), minutes(h.try_cast("int"), m.try_cast("int")))


# --- buckets and calendar -------------------------------------------------

def bucket(rules: Sequence[tuple[Column, str]], default: str, value: Column | None = None, null_label: str | None = None) -> Column:
    """First label whose predicate holds, else ``default``.

    A NULL input fails every comparison and therefore takes ``default``, unless
    ``null_label`` names another label for a NULL ``value``.
    """
    if null_label is not None:
        if value is None:
            raise ValueError("null_label needs the value that may be NULL")
        rules = [(value.isNull(), null_label), *rules]
    pred, label = rules[0]
    out = F.when(pred, F.lit(label))
    for pred, label in rules[1:]:
        out = out.when(pred, F.lit(label))
    return out.otherwise(F.lit(default))


# Duration buckets (minutes) and their labels.
SHORT_LT, MEDIUM_LE = 90, 150
SHORT, MEDIUM, LONG = "Corta", "Media", "Larga"


def duration_bucket(c: ColumnOrName, null_label: str | None = None) -> Column:
    """< 90 Corta, <= 150 Media, otherwise (including NULL, without ``null_label``) Larga."""
    col = _c(c)
    return bucket([(col < SHORT_LT, SHORT), (col <= MEDIUM_LE, MEDIUM)], LONG, col, null_label)


# Score buckets (lower bounds) and their labels.
SCORE_BUCKETS = ((8, "Excelente"), (7, "Buena"), (5, "Regular"))
SCORE_DEFAULT = "Baja"


def score_bucket(c: ColumnOrName, null_label: str | None = None) -> Column:
    """>= 8 Excelente, >= 7 Buena, >= 5 Regular, otherwise (including NULL, without ``null_label``) Baja."""
    col = _c(c)
    return bucket([(col >= lo, label) for lo, label in SCORE_BUCKETS], SCORE_DEFAULT, col, null_label)


def decade(year: ColumnOrName) -> Column:
    """floor(year / 10) * 10 as INT."""
    return (F.floor(_c(year) / 10) * 10).cast("int")


# --- amounts --------------------------------------------------------------

def prefer(first: ColumnOrName, second: ColumnOrName, null_if_nonpositive: bool = False) -> Column:
    """First non-NULL of two sources (the first one wins when both are known).

    With ``null_if_nonpositive`` a first source of zero or less is unknown too,
    and does not hide the second one.
    """
    return F.coalesce(positive_or_null(first) if null_if_nonpositive else _c(first), _c(second))


def positive_or_null(c: ColumnOrName) -> Column:
    """Keep values > 0; zero, negatives and NULL become NULL (unknown)."""
    col = _c(c)
    return F.when(col > 0, col)


def round_half_up(c: ColumnOrName, digits: int) -> Column:
    """HALF_UP rounding, once, of a decimal or of a double's shortest decimal form
    (1.005 -> 1.01, 7.4949998 -> 7.49)."""
    return F.round(_c(c), digits).cast("double")


def exact_sum(c: ColumnOrName) -> Measure:
    """Exact sum of a number column, rounded once to a double (for ``kpi``; see ``functions.exact``)."""
    return Measure("sum", _c(c))


def exact_avg(c: ColumnOrName) -> Measure:
    """Exact sum over the count of values, rounded once to a double (for ``kpi``)."""
    return Measure("avg", _c(c))


def whole_sum(c: ColumnOrName) -> Measure:
    """Sum of whole amounts as BIGINT; NULL when the sum is no BIGINT (for ``kpi``)."""
    return Measure("whole", _c(c))


def row_count() -> Measure:
    """Number of rows of the group (for ``kpi``)."""
    return Measure("rows", None)


def ratio(num: ColumnOrName, den: ColumnOrName, digits: int = 2) -> Column:
    """round(num / den, digits) when den > 0, else NULL (never divides by zero)."""
    n, d = _c(num), _c(den)
    return F.when(d > 0, round_half_up(n.cast("double") / d.cast("double"), digits))


def agrees(a: ColumnOrName, b: ColumnOrName) -> Column:
    """Three-valued equality: NULL when either side is unknown."""
    return _c(a) == _c(b)
