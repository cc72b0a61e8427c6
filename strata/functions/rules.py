"""Row-level quality rules as Spark Column expressions.

Every rule is a plain built-in expression: it stays inside whole-stage
codegen, pushes down where the source allows, and gives the same answer
whether the session runs with ``spark.sql.ansi.enabled`` on or off (no rule
ever raises on bad input; bad input yields NULL and the row is dropped).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bytes that Spark's non-ANSI string -> integer cast skips at
# both ends of the text (ASCII whitespace and control characters).
_EDGE = r"[\x00-\x20\x7F]*"
# Text the non-ANSI cast reads as an integer: optional sign, then digits with
# an optional fraction that is cut off, or a bare fraction (".5" -> 0).
# Group 1 is the sign, group 2 the integral digits (absent for a bare fraction).
_LEGACY_INT = r"\A" + _EDGE + r"([+-]?)(?:([0-9]+)(?:[.][0-9]*)?|[.][0-9]*)" + _EDGE + r"\z"
# A date text must have exactly this shape before it is parsed.
_ISO_DAY = r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}\z"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def not_blank(c: str | Column) -> Column:
    """True when the value is neither NULL nor the empty string.

    Whitespace-only text is *not* blank here; the CSV writer already turns it
    into NULL on the way into bronze.
    """
    c = _col(c)
    return c.isNotNull() & (c != F.lit(""))


def lenient_int(c: str | Column) -> Column:
    """Text -> int with the semantics of Spark's non-ANSI ``CAST(x AS INT)``.

    Leading/trailing blanks are skipped, a fraction is truncated toward zero
    (``'30.5'`` -> 30, ``'.5'`` -> 0), anything else (exponents, words,
    overflow) is NULL. Never raises, whatever the session's ANSI setting.

    Three tiers, cheapest first, so that malformed text never pays for a
    failed cast (a failing ``try_cast`` costs an exception inside the JVM):
    plain digit strings of up to 9 characters cannot overflow and are cast
    directly; other text is cast only when it has the accepted shape, after
    a rewrite to ``<sign>0<digits>`` (only well-shaped text that overflows
    still fails a cast); text of any other shape is NULL.
    """
    x = _col(c)
    plain = F.length(x).between(1, 9) & (F.translate(x, "0123456789", "") == F.lit(""))
    shaped = F.regexp_replace(x, _LEGACY_INT, "$10$2").try_cast("int")
    return F.when(plain, x.cast("int")).when(x.rlike(_LEGACY_INT), shaped)


def int_between_exclusive(c: str | Column, low: int, high: int) -> Column:
    """``low < int(c) < high`` for a text column; NULL (row dropped) when unparsable."""
    # low < v < high  <=>  |2v - (low + high)| < high - low, written with a
    # single reference to v so the parse runs once per row.
    v = lenient_int(c).cast("long")
    return F.abs(v * 2 - F.lit(low + high)) < F.lit(high - low)


def date_prefix(c: str | Column, sep: str = " ", fmt: str = "yyyy-MM-dd") -> Column:
    """Date parsed from the text before the first ``sep`` (literal); NULL when unparsable.

    ``'2025-05-10 10:30:00'`` -> 2025-05-10; ``'2025-5-1'``, ``'2025-02-30'``,
    ``' 2025-05-10'`` -> NULL.

    For the default format only text of the exact shape ``dddd-dd-dd``
    reaches a parser, and that parser is the plain text -> date cast, which
    on such text agrees with ``to_date(x, 'yyyy-MM-dd')`` (calendar checks
    included) and never consults the session's time-parser policy. Malformed
    text never reaches a parser; only an impossible calendar date such as
    ``2025-02-30`` costs an exception, caught inside Spark. Handing the text
    to ``try_to_date`` instead would
    raise under the EXCEPTION policy and parse leniently under LEGACY
    (``'2025-05-1x'`` -> 2025-05-01). Other formats go to ``try_to_date``.
    """
    head = F.substring_index(_col(c), sep, 1)
    if fmt == "yyyy-MM-dd":
        return F.when((F.length(head) == 10) & head.rlike(_ISO_DAY), head.try_cast("date"))
    return F.try_to_date(head, fmt)
