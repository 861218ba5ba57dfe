"""All registered queries."""

from txwarden.catalog import drift, metrics, models, profile, scans, streams  # noqa: F401
from txwarden.catalog.registry import ENTRIES

__all__ = ["ENTRIES"]
