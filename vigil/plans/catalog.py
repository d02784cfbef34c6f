"""Imports every query module so that its queries register themselves."""

from __future__ import annotations

from vigil.plans import registry

_MODULES = ["vigil.plans.log_queries", "vigil.plans.feed_queries", "vigil.plans.search_queries", "vigil.plans.class_queries", "vigil.plans.pipeline_queries", "vigil.plans.platform_queries", "vigil.plans.record_queries", "vigil.plans.stream_queries"]


def load():
    import importlib
    for m in _MODULES:
        importlib.import_module(m)
    return registry.QUERIES, registry.ORACLES
