"""All registered queries and oracles; importing this package registers them."""

from harborline.registry import files, forecasts, marts, quality, reviews, streams, trips  # noqa: F401
from harborline.registry.core import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
