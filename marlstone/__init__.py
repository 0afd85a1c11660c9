"""marlstone: a batch retail lakehouse on Spark DataFrames.

Bronze (raw Parquet) -> Silver (cleaned) -> Gold (star schema and marts) ->
serving tables. See README.md for the operator map.
"""

__version__ = "0.1.0"
