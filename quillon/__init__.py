"""A Spark-first engine for spatially barcoded sequencing reads and what is derived from them."""

__version__ = "0.1.0"
