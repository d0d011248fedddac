"""All catalogue queries; importing this module registers them."""

from . import q_containment, q_io, q_itemsets, q_lookup, q_metrics, q_models, q_patterns, q_sequences, q_text  # noqa: F401
from .registry import REGISTRY

__all__ = ["REGISTRY"]
