"""millrace: table intake, clean-up, checking and storing on Spark DataFrames."""

__version__ = "0.1.0"
