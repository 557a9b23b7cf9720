"""Models (M1-M18) and the registered stand-in queries over the test tables."""

from __future__ import annotations


def catalog_of_queries():
    """Import every query module (registration happens on import) and return
    ``(QUERIES, ORACLE)``."""
    from tidemark.plans import registry
    from tidemark.plans import (backfill_runs, enrichment, fact_run, filechecks, landing_schemas, loads,  # noqa: F401
                                model_runs, reconcile, snapshots, streams)

    return registry.QUERIES, registry.ORACLE
