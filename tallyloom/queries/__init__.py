"""Named queries over the star schema, event, text and vector tables."""

from tallyloom.queries.registry import REGISTRY, Query
from tallyloom.queries import cleaning, clusters, learning, retail, scans, screentime, text, titles, vectors  # noqa: F401,E402

__all__ = ["REGISTRY", "Query"]
