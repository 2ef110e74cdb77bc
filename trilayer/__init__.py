"""Retail analytics on Spark: raw tables in, a clean silver layer, gold models out.

Everything is a function from DataFrame to DataFrame; only ``trilayer.sources``
and ``trilayer.operators.settle`` touch storage.
"""

from trilayer.config import LayerConfig

__all__ = ["LayerConfig"]
