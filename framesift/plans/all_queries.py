"""Importing this module registers every query."""

from framesift.plans import annotation_queries, dedup_queries, export_queries, file_queries, writeback_queries  # noqa: F401
from framesift.plans.registry import ORACLE_SQL, QUERIES  # noqa: F401
