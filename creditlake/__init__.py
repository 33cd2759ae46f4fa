"""Batch analytics on consumer-credit tables, written as Spark DataFrame jobs."""

from creditlake.plans.pipeline import build_layers
from creditlake.sources.layers import Layer

__all__ = ["Layer", "build_layers"]
