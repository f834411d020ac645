"""Transition-alignment analytics as Spark DataFrame stages."""

from pathgauge.params import Params, profile

__all__ = ["Params", "profile"]
