"""Named queries over the driver tables and their DuckDB oracle SQL."""

from dosewise.plans.registry import ORACLES, QUERIES  # noqa: F401

_MODULES = ["q_courses", "q_explore", "q_demand", "q_affinity", "q_quality", "q_models", "q_streaming", "q_checks", "q_tables"]


def load_all():
    import importlib
    for m in _MODULES:
        importlib.import_module(f"dosewise.plans.{m}")
    return QUERIES, ORACLES
