"""Declarative bronze -> silver refinement.

``refine`` turns a rule spec into one Filter, one Project and (optionally) one
whole-row dedup. Catalyst merges the predicates into a single Filter, pushes
the NULL/blank tests into the scan, and plans the dedup as a partial + final
HashAggregate, so repeated rows collapse map-side before the shuffle (a hot
duplicate costs one row per task, not one row per copy).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import add, and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.fixed import (
    APPOINTMENT_AGE, APPOINTMENT_COLUMNS, APPOINTMENT_DATE, APPOINTMENT_NOT_BLANK, DATE_FORMAT,
    DATE_SEPARATOR,
)
from strata.functions.rules import date_prefix, int_between_exclusive, not_blank


@dataclass(frozen=True)
class RefineSpec:
    """What a refinement keeps and how it retypes.

    not_blank:   text columns that must be neither NULL nor ``''``.
    int_ranges:  ``(column, low, high)``: keep ``low < int(column) < high``;
                 the column stays text.
    dates:       text columns replaced in place by the date before the first
                 ``date_sep``; rows where that date is NULL are dropped.
    dedup:       drop whole-row duplicates (all columns, after retyping).
    """

    not_blank: tuple[str, ...] = ()
    int_ranges: tuple[tuple[str, int, int], ...] = ()
    dates: tuple[str, ...] = ()
    date_sep: str = DATE_SEPARATOR
    date_format: str = DATE_FORMAT
    dedup: bool = True


def spec_from_dict(d: dict) -> RefineSpec:
    """A spec from plain data, e.g. parsed JSON::

        {"not_blank": ["nombre"], "int_ranges": [["edad", 0, 120]],
         "dates": ["fecha_turno"], "dedup": true}
    """
    known = {"not_blank", "int_ranges", "dates", "date_sep", "date_format", "dedup"}
    unknown = set(d) - known
    if unknown:
        raise ValueError(f"unknown refine spec keys: {sorted(unknown)}")
    return RefineSpec(
        not_blank=tuple(d.get("not_blank", ())),
        int_ranges=tuple((str(c), int(lo), int(hi)) for c, lo, hi in d.get("int_ranges", ())),
        dates=tuple(d.get("dates", ())),
        date_sep=d.get("date_sep", DATE_SEPARATOR),
        date_format=d.get("date_format", DATE_FORMAT),
        dedup=bool(d.get("dedup", True)),
    )


# The appointments ("pacientes") rule set of the source pipeline (values in strata.fixed).
APPOINTMENTS = RefineSpec(
    not_blank=APPOINTMENT_NOT_BLANK,
    int_ranges=(APPOINTMENT_AGE,),
    dates=(APPOINTMENT_DATE,),
    dedup=True,
)

__all__ = ["APPOINTMENTS", "APPOINTMENT_COLUMNS", "MAX_RULES", "RefineSpec", "broken_rules", "refine", "row_filter",
           "rule_names", "rules_of", "spec_from_dict"]

MAX_RULES = 63  # bits of a long


def _row_rules(spec: RefineSpec) -> dict[str, Column]:
    rules = {f"not_blank:{c}": not_blank(c) for c in spec.not_blank}
    return rules | {f"int_range:{c}:{lo}:{hi}": int_between_exclusive(c, lo, hi) for c, lo, hi in spec.int_ranges}


def row_filter(spec: RefineSpec):
    """The spec's row predicates as one Column (None when there are none)."""
    preds = list(_row_rules(spec).values())
    return reduce(and_, preds) if preds else None


def rules_of(spec: RefineSpec) -> dict[str, Column]:
    """Every rule that can reject a row, by name, in the order of their bits: ``not_blank:<column>``,
    ``int_range:<column>:<low>:<high>``, ``date:<column>``. A rule named twice counts once."""
    rules = _row_rules(spec)
    rules |= {f"date:{c}": date_prefix(c, spec.date_sep, spec.date_format).isNotNull() for c in spec.dates}
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules; a bit set holds {MAX_RULES}")
    return rules


def broken_rules(spec: RefineSpec) -> Column:
    """The rules that a row breaks, as a bit set (long): bit ``i`` for the ``i``-th of ``rules_of``. ``refine`` keeps a row exactly
    when it is 0; a rule whose result is NULL is broken."""
    bits = [F.when(rule, F.lit(0)).otherwise(F.lit(1 << i)).cast("long") for i, rule in enumerate(rules_of(spec).values())]
    return reduce(add, bits, F.lit(0).cast("long"))


def rule_names(bits: str | Column, spec: RefineSpec) -> Column:
    """The names of the rules in a bit set, as an array in the order of the rules."""
    bits = F.col(bits) if isinstance(bits, str) else bits
    return F.filter(F.array(*[F.when(bits.bitwiseAND(F.lit(1 << i).cast("long")) != 0, F.lit(n))
                              for i, n in enumerate(rules_of(spec))]).cast("array<string>"), lambda n: n.isNotNull())


def refine(df: DataFrame, spec: RefineSpec = APPOINTMENTS) -> DataFrame:
    """Apply ``spec`` to ``df``: filter, retype dates in place, drop NULL dates, dedup.

    Columns not named by the spec pass through untouched and take part in
    the dedup. The result is lazy; nothing runs until an action or a write.
    """
    cond = row_filter(spec)
    if cond is not None:
        df = df.filter(cond)
    if spec.dates:
        df = retype(df, spec).dropna(subset=list(spec.dates))
    if spec.dedup:
        df = df.dropDuplicates()
    return df


def retype(df: DataFrame, spec: RefineSpec) -> DataFrame:
    """The spec's date columns as dates, in place; no row is dropped."""
    return df.withColumns({c: date_prefix(c, spec.date_sep, spec.date_format) for c in spec.dates}) if spec.dates else df
