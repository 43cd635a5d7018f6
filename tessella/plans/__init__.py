"""Plans: the registered queries of the reference operators and the pipeline that chains them."""

from __future__ import annotations

from importlib import import_module

MODULES = ("interval_queries", "text_queries", "audio_queries", "record_queries", "kernel_queries", "batch_queries")


def register() -> None:
    """Import every module of queries, which registers them."""
    for name in MODULES:
        import_module(f"tessella.plans.{name}")
