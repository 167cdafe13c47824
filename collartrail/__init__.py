"""Animal-collar telemetry on Spark: tracks, mortality dates, video pairing.

Every operator takes and returns DataFrames and works on all collars at once.
"""

__version__ = "0.1.0"
