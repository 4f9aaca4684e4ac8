"""strata: layered (Bronze/Silver/Gold) order processing on Spark DataFrames."""

__version__ = "0.1.0"
