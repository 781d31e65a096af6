"""riskloom: entity-feature, pricing and scoring-telemetry analytics as plain Spark DataFrame jobs.

Every operator takes DataFrames and returns a DataFrame; the clock, the reference year and the
seed are arguments, so a plan gives the same rows whenever and wherever it runs.
"""

__version__ = "0.1.0"
