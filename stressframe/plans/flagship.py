"""The flagship query used by the driver's smoke check."""

from stressframe.plans.q_features import flagship

__all__ = ["flagship"]
