"""Registered queries: each operator run over the driver's tables, beside an
independent SQL statement of the same result."""

from __future__ import annotations

from tamarind.catalog.base import REGISTRY, Query


def load() -> dict[str, Query]:
    """Import every query module and return the registry."""
    from tamarind.catalog import (  # noqa: F401
        aggregates,
        classifiers,
        entities,
        joins,
        model,
        quality,
        reports,
        refined,
        roundtrips,
        scalars,
        streams,
        windows,
    )

    return REGISTRY
