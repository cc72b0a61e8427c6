"""DataFrame operators: refinement and run selection."""

from strata.operators.refine import APPOINTMENTS, RefineSpec, refine, row_filter
from strata.operators.runs import domain_of, latest_run, run_of_path, run_stamp

__all__ = ["APPOINTMENTS", "RefineSpec", "domain_of", "latest_run", "refine", "row_filter",
           "run_of_path", "run_stamp"]
