"""ticksmith: match-telemetry analytics as Spark DataFrame jobs.

Layers: bronze (all-string landed Parquet, one partition per match),
silver (typed, cleaned), gold (player x match facts, dimensions,
rankings), data-quality checks and paged reads.  Every operator is a
plain function from DataFrames to a DataFrame; nothing is collected to
the driver on the data path.
"""

__version__ = "0.1.0"
