"""tidepool: bounded and streaming analytics jobs as plain DataFrame functions.

Every job takes DataFrames and returns a DataFrame, so the same code runs
under ``spark.read`` (batch) and ``spark.readStream`` (streaming) wherever
Structured Streaming allows the operators involved.
"""

__version__ = "0.1.0"
