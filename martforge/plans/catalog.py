"""All registered queries (importing the modules fills the registry)."""

from __future__ import annotations

from . import catalog_core  # noqa: F401
from .registry import ORACLE, QUERIES

for _mod in ("catalog_quality", "catalog_scd2", "catalog_io", "catalog_stream", "catalog_jobs"):
    try:
        __import__(f"{__package__}.{_mod}")
    except ModuleNotFoundError as e:  # module not written yet
        if _mod not in str(e):
            raise

__all__ = ["ORACLE", "QUERIES"]
