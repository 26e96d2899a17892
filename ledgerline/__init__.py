"""ledgerline: premium-accrual reporting on Spark DataFrames.

Tour:

* ``config``      report period, rule-version presets (``Variant``), partner lists.
* ``sources``     ``Catalog`` (logical table name -> DataFrame from parquet, JDBC or the
                  test fixtures) and the month x product layout of the bookings fact.
* ``functions``   collation-aware string tests and calendar helpers (SQL expressions).
* ``operators``   rule ladders compiled to CASE expressions, partner universes and the
                  partner join, special deals, counted lookups and spread dimensions.
* ``plans``       the reports: lead-level and summary per product line, persistency,
                  annual clubs, the combined dataset and the run-all entry point.
* ``registry``    the registered queries used by ``__spark_entry__`` and ``bench.py``.
"""
