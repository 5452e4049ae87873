"""marketframe: a Spark-native market-data engine.

Every public operator is a plain ``DataFrame -> DataFrame`` function built on
Spark SQL expressions, so it composes with ``df.transform`` and scales with
the cluster. Sub-packages:

* ``sources``   - feed normalizers (landed JSON -> flat tables), storage, input bindings
* ``functions`` - scalar column helpers (rounding, labels, formats, epochs)
* ``operators`` - series index and blocked windows, cleaning, indicators,
                  quote analysis, run reports, dashboard queries
* ``plans``     - the query catalogue and its DuckDB oracle SQL
* ``streaming`` - Structured Streaming jobs (clean, events, status, dedup)
"""

__version__ = "0.1.0"
