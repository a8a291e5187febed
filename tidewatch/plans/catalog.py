"""Imports every query module so the registry is complete."""

from __future__ import annotations

import importlib
import logging

from tidewatch.plans.registry import ORACLE, QUERIES

_MODULES = (
    "tidewatch.plans.q_scoring",
    "tidewatch.plans.q_series",
    "tidewatch.plans.q_modal",
    "tidewatch.plans.q_network",
    "tidewatch.plans.q_fusion",
    "tidewatch.plans.q_topic_math",
    "tidewatch.plans.q_ingest",
    "tidewatch.plans.q_connectors",
    "tidewatch.plans.q_adhoc",
    "tidewatch.plans.q_streaming",
    "tidewatch.plans.q_topics",
    "tidewatch.plans.q_learned",
)

log = logging.getLogger(__name__)


def load() -> tuple[dict, dict]:
    """Registered queries and oracle SQL; a module that fails to import is
    logged and costs only its own queries."""
    for m in _MODULES:
        try:
            importlib.import_module(m)
        except Exception:
            log.exception("query module %s could not be loaded", m)
    return QUERIES, ORACLE
