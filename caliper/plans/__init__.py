"""Registered query plans over the driver tables (one module per operator family)."""

from __future__ import annotations

import importlib

_MODULES = ["profile_queries", "text_queries", "eval_queries", "model_queries", "topic_queries", "job_queries"]


def load_all():
    from caliper.plans.registry import REGISTRY
    for m in _MODULES:
        importlib.import_module(f"caliper.plans.{m}")
    return REGISTRY
