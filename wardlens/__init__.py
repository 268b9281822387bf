"""wardlens — batch analytics for hospital operations on Spark DataFrames.

Layout:
  fixed_values  values that must equal the source system's (codes, patterns,
                cutoffs, indicator texts, keys, string lengths)
  schemas       declared StructTypes of the model tables
  session       session builder and the shared folder for written intermediates
  sources/      readers and writers with declared schemas (Parquet/ORC/CSV/JSON,
                JDBC, clustered and bucketed layouts), adapter from the
                benchmark tables
  functions/    column helpers (exact money/ratio arithmetic, predicates)
  operators/    derivations, role reports, joins, data-quality checks
  plans/        quality indicators, publishing, the query catalog and its oracle

``python -m wardlens`` runs reports, the indicator job and the checks as batch
jobs.
"""

__version__ = "0.1.0"
