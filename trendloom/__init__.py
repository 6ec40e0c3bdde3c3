"""trendloom: catalog-trend analytics as lazy Spark DataFrame jobs.

Layers:
  functions/  pure Column expressions (cleaning, decades, genres)
  operators/  DataFrame -> DataFrame building blocks (filters, aggregates,
              windows, pivots, ordering, column resolution)
  sources/    readers and writers (delimited sniffing, JSON lines, layout)
  plans/      end-to-end jobs (ETL, aggregate build, genre share, reports)
"""

__version__ = "0.1.0"
