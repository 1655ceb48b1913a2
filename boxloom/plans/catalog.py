"""All registered queries."""

from boxloom.plans import q_boxes, q_detection, q_manifest, q_review, q_sources, q_streaming, q_tracking  # noqa: F401
from boxloom.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
