"""Layer storage, old-layout adoption and table publishing."""

from strata.sources.layers import (
    list_runs, read_latest, read_layer, read_raw_csv, read_run, resolve_run, write_run,
)
from strata.sources.legacy import adopt_legacy_runs, legacy_runs
from strata.sources.tables import JdbcTarget, publish_jdbc, publish_table, to_publishable

__all__ = ["JdbcTarget", "adopt_legacy_runs", "legacy_runs", "list_runs", "publish_jdbc",
           "publish_table", "read_latest", "read_layer", "read_raw_csv", "read_run",
           "resolve_run", "to_publishable", "write_run"]
