"""tidewatch: sensor-reading stream analytics on Spark DataFrames.

Operators are plain ``DataFrame -> DataFrame`` functions that Catalyst plans;
the same functions serve batch tables and Structured Streaming inputs where
Spark allows it.
"""

__version__ = "0.1.0"
