"""Query plans: the registry of named queries and their oracles."""
from __future__ import annotations


def load_all():
    """Import every catalog module (registration happens on import) and return the registry."""
    from . import catalog, catalog_explore, catalog_model, catalog_scores, catalog_stream  # noqa: F401
    from .registry import REGISTRY
    return REGISTRY
