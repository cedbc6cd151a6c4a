"""termloom: document-term analytics and corpus operators on PySpark DataFrames."""

__version__ = "0.1.0"
