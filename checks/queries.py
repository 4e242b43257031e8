"""Imports every module that registers queries."""

from checks import change_queries, gold_queries, report_queries, stream_queries  # noqa: F401
