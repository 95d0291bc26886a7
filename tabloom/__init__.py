"""tabloom: tabular feature, scoring and evaluation jobs on Spark DataFrames."""

__version__ = "0.1.0"
