"""Courier event analytics as Spark DataFrame transformations."""

from courierlens.params import EventParams, RfmParams

__all__ = ["EventParams", "RfmParams"]
