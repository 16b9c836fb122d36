"""Stand-in inputs derived from the given tables, the registered queries and their SQL."""

import importlib

MODULES = ("q_sources", "q_decode", "q_scalars", "q_rows", "q_filters", "q_joins", "q_state", "q_counts",
           "q_routes", "q_streams", "q_jobs")


def load_all() -> None:
    """Import every module that registers queries."""
    for name in MODULES:
        importlib.import_module(f"workload.{name}")
