"""Imports every module that registers queries."""

from hearth.plans import registry  # noqa: F401
from hearth.plans import q_features, q_model, q_quality, q_relational, q_stats, q_workflow  # noqa: F401
