"""All checks, by name."""

from checks import event_checks, month_checks, operator_checks, order_checks  # noqa: F401
from checks.harness import CHECKS

__all__ = ["CHECKS"]
