"""All registered queries; importing the job modules fills the registry."""

from datamill.plans import anomaly, concepts, linkage, network, recommender, trees  # noqa: F401
from datamill.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
