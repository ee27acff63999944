"""Named queries of the training-data operators (one per operator)."""

from __future__ import annotations

from dosewise.llm.common import ORACLES, QUERIES  # noqa: F401
from dosewise.llm import q_audit, q_filters, q_models, q_text  # noqa: F401  (they register)
