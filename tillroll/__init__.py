"""tillroll: loyalty and delivery analytics as Spark DataFrame operators.

Sub-packages:

* ``functions`` -- Column-level helpers (text cleaning, list parsing, calendar math).
* ``operators`` -- DataFrame -> DataFrame building blocks (extremes with ties,
  null-aware NOT IN, list explode/membership, ordered concatenation, ...).
* ``sources``   -- table adapters (testdata parquet -> loyalty/delivery tables),
  declared schemas and sinks.
* ``plans``     -- one function per named query, a registry and the DuckDB oracle.
"""

__version__ = "0.1.0"
