"""All registered queries; importing the modules registers them."""

from . import changes, desk, scans, text  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
