"""Payment-risk analytics on Spark: enrich, label, alert, route, report, train."""

from tillwarden.config import RuleConfig

__all__ = ["RuleConfig"]
