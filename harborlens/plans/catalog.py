"""Query catalog: each operator bound to the driver tables, with its SQL oracle.

``QUERIES[name] = (build, sql)``: ``build(spark, sf_dir) -> DataFrame`` runs the
operator on Spark; ``sql`` is the same question in DuckDB SQL over the driver's
views (``None`` where no SQL form exists).  Output columns carry the same names
and types in both, so the comparison can hash values.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from harborlens.sources.tables import Tables

Builder = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, tuple[Builder, str | None]] = {}


def register(name: str, sql: str | None = None):
    """Decorator: ``fn(t: Tables) -> DataFrame`` becomes a catalog entry."""

    def deco(fn):
        def build(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Tables(spark, sf_dir))

        build.__name__ = name
        build.__doc__ = fn.__doc__
        QUERIES[name] = (build, sql)
        return fn

    return deco


def _load() -> None:
    # Importing the modules fills QUERIES.
    from harborlens.plans import queries_events  # noqa: F401
    from harborlens.plans import queries_capacity  # noqa: F401
    from harborlens.plans import queries_sli  # noqa: F401
    from harborlens.plans import queries_inventory  # noqa: F401
    from harborlens.plans import queries_policy  # noqa: F401
    from harborlens.plans import queries_recovery  # noqa: F401
    from harborlens.plans import queries_network  # noqa: F401
    from harborlens.plans import queries_io  # noqa: F401


def all_queries() -> dict[str, Builder]:
    _load()
    return {k: v[0] for k, v in QUERIES.items()}


def all_oracles() -> dict[str, str]:
    _load()
    return {k: v[1] for k, v in QUERIES.items() if v[1] is not None}
