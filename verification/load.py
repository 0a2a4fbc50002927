"""Import every query module so that the registry is complete."""

from verification import q_features, q_io, q_models, q_reports, q_scale, q_text, q_trained  # noqa: F401
from verification.registry import REGISTRY

__all__ = ["REGISTRY"]
