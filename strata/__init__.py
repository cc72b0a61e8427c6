"""strata: a layered (bronze -> silver -> diamond -> gold) lake on Spark DataFrames.

Public API, by module:

* ``strata.functions.rules`` -- row rules as Column expressions:
  ``not_blank``, ``lenient_int``, ``int_between_exclusive``, ``date_prefix``.
* ``strata.operators.refine`` -- ``RefineSpec``, ``APPOINTMENTS``, ``refine``.
* ``strata.operators.runs`` -- run keys: ``run_stamp``, ``domain_of``,
  ``latest_run`` (lazy), ``run_of_path``.
* ``strata.sources.layers`` -- layer storage: ``write_run``, ``write_runs``, ``read_run``,
  ``read_latest``, ``read_layer``, ``list_runs``, ``resolve_run``,
  ``run_bytes``, ``read_raw_csv``, ``list_landing``.
* ``strata.sources.legacy`` -- runs stored under the old per-run names:
  ``legacy_runs``, ``adopt_legacy_runs``, ``legacy_backups``, ``adopt_legacy_backups``.
* ``strata.sources.tables`` -- publishing: ``to_publishable``,
  ``publish_table``, ``publish_jdbc``, ``JdbcTarget``, ``jdbc_table_exists``.
* ``strata.plans.pipeline`` -- the steps: ``ingest``, ``ingest_landing``,
  ``refine_latest``, ``promote``, ``publish``, ``run_pipeline``, ``LakeRoots``.
* ``strata.session`` -- ``checkpoint_root``, ``scratch_dir``, ``session_with``,
  ``shuffle_partitions_for``.
* ``strata.fixed`` -- names and formats shared with the source pipeline.
* ``python -m strata`` -- one subcommand per step.
"""

__version__ = "0.1.0"
