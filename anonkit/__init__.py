"""anonkit: anonymization, privacy audits and purpose-limited analytics on Spark DataFrames."""

__version__ = "0.1.0"
