"""Queries over the driver tables, each beside the SQL that gives the same result."""

from __future__ import annotations

from importlib import import_module

MODULES = ("cdc_plans", "snapshot_plans", "keyed_plans", "metric_plans", "quality_plans", "nested_plans", "io_plans", "synth_plans")


def load_all():
    for name in MODULES:
        import_module(f"tidewell.plans.{name}")
