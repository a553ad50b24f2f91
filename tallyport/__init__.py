"""tallyport: move tabular data with Spark and prove that it arrived intact."""

__version__ = "0.1.0"
