"""The registered queries over the test tables."""

from checks import evaluation, growth, layout, models, preparation, statistics  # noqa: F401
from checks.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
