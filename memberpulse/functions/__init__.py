"""Column-level helpers: calendar arithmetic, ratios and member predicates."""

from memberpulse.functions import predicates, ratios, temporal

__all__ = ["predicates", "ratios", "temporal"]
