"""wavelake: multi-wave questionnaire analytics on Spark DataFrames and SQL."""

__version__ = "0.1.0"
