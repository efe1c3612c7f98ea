"""quarry: DataFrame-to-DataFrame analytics on PySpark.

Sub-packages:
  sources    -- readers for the driver tables and for CSV / fixed-width / text files, plus sinks
  functions  -- Column-expression builders (text, scalar, vector); no Python UDFs
  operators  -- DataFrame -> DataFrame operators (pivot, profile, text, vectors, models, densities)
  plans      -- the registered queries over the driver tables and their DuckDB oracles
  streaming  -- incremental (availableNow) version of the daily pivot job
"""

__all__ = ["session"]
