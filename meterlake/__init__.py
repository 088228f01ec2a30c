"""Smart-meter analytics as PySpark DataFrame operators."""

from meterlake.params import Params

__all__ = ["Params"]
