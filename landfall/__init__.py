"""landfall: a Spark-native pipeline for border-arrival records.

Stages, each a DataFrame -> DataFrame step that Catalyst plans as a whole:

* ``sources``   landing of monthly extracts, label text files and airports;
                Parquet / JDBC warehouse tables; the fixture views used in tests.
* ``functions`` column expressions (casts, SAS dates, label code rules,
                date parts, periods) -- all built-in Spark expressions, no UDFs.
* ``operators`` profiling, lookups, staging, star schema, quality checks.
* ``plans``     the analysis questions and the end-to-end flows.
* ``streaming`` incremental ingestion of new extract files.
"""

__version__ = "0.1.0"
