"""tidemark: survey reconciliation and analytics as Spark DataFrame operators.

Every operator is a function ``DataFrame -> DataFrame`` (or ``Column -> Column``)
built from Spark SQL expressions, with column names passed as parameters.

Layout
------
``functions``  Column-level helpers (codes, dates, numbers, vectors, geodesy).
``operators``  DataFrame-level operators grouped by family (normalise, sites,
               reconcile, metrics, quality, community, geometry).
``sources``    readers and writers.
``plans``      registered queries over the driver tables, each with an
               equivalent SQL text for the DuckDB oracle.
``streaming``  incremental ingest of new survey sheets (file stream).
"""

__version__ = "0.1.0"
