"""Scalar column helpers (projections, rounding, labels, formats, epochs)."""
from .scalar import *  # noqa: F401,F403
