"""The pipeline steps; registered queries live in ``strata.plans.queries``."""

from strata.plans.pipeline import (
    LakeRoots, PublishResult, ingest, ingest_landing, promote, publish, refine_latest, run_pipeline,
)

__all__ = ["LakeRoots", "PublishResult", "ingest", "ingest_landing", "promote", "publish",
           "refine_latest", "run_pipeline"]
