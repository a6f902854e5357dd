"""Registered queries, each beside its SQL counterpart where there is one."""

from . import columns, layouts, models, relations, scans, tables, text, topics, vectors  # noqa: F401
from .registry import ORACLES, QUERIES  # noqa: F401
