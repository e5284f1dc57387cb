"""marquee: a Spark-native toolkit for cleaning and reporting on media-catalog data.

Layout
------
``sources``    raw CSV scan, the versioned table store, CSV export, testdata adapter
``functions``  column-expression helpers (whitespace strip, date parsing, shares)
``operators``  DataFrame -> DataFrame building blocks (ingest, clean, upsert, reports)
``plans``      the named reports, the monthly job / backfill, and the query registry
``streaming``  file-stream ingestion feeding the same keyed upsert
"""

__all__ = ["schema"]
