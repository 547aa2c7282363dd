"""martloom: DataFrame operators and jobs for incremental warehouse loading on Spark."""

__version__ = "0.1.0"
