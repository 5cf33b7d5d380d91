"""panelweft: region-by-year panel operators on Spark DataFrames."""

__version__ = "0.1.0"
