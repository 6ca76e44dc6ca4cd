"""tickerlens: market-headline analytics as Spark DataFrame operators.

Layout:
  functions/  Column -> Column scalars (text cleaning, language, verdicts, formats)
  sources/    scans of stored pages, HTML tables, TSV/CSV/Parquet inputs
  operators/  DataFrame -> DataFrame operators (linking, dedupe, features,
              sentiment, quotes, valuation, store sinks, enrichment hook)
  plans/      whole jobs composed from operators, driver-table adapters
  streaming/  the incremental (micro-batch) headline job
"""

__version__ = "0.1.0"
