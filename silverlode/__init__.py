"""Batch analytics warehouse on Spark: raw extracts -> cleaned tables -> star schema -> reports."""

from silverlode.job import Job, Limits
from silverlode.warehouse import Warehouse

__all__ = ["Job", "Limits", "Warehouse"]
