"""Lotline: parcel purchase-candidate analytics as plain PySpark DataFrame jobs."""

from lotline.config import JobConfig

__all__ = ["JobConfig"]
