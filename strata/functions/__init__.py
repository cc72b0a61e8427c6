"""Row rules as Spark Column expressions."""

from strata.functions.rules import date_prefix, int_between_exclusive, lenient_int, not_blank

__all__ = ["date_prefix", "int_between_exclusive", "lenient_int", "not_blank"]
