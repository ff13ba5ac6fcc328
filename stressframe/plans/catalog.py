"""All registered queries: importing this module fills the registry."""

from __future__ import annotations

from stressframe.plans import q_clean, q_estimate, q_features, q_metrics, q_models, q_policy, q_profile, q_sources, q_study  # noqa: F401
from stressframe.plans.registry import ORACLE_SQL, QUERIES

__all__ = ["QUERIES", "ORACLE_SQL"]
