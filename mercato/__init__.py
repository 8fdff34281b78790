"""mercato: a marketplace medallion pipeline on Spark DataFrames.

Layers (all lazy DataFrame transformations, I/O only at the edges):

* ``sources``   -- bronze ingestion (CSV, JSON), silver/gold Parquet sinks.
* ``functions`` -- column helpers that pin down the pipeline's semantics
  (whitespace trim, date parsing, whole-day differences, money sums, ...).
* ``operators`` -- reusable relational building blocks (suffix-safe joins,
  skew-safe keep-one-per-key, expectation rules compiled to aggregates).
* ``plans``     -- the silver cleaning rules, the fifteen gold reports, the
  quality guards, the output audit and the end-to-end job.
"""

__version__ = "0.1.0"
