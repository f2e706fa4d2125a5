"""effdated — Spark-native toolkit for effective-dated records.

Every operator is a plain ``DataFrame -> DataFrame`` function built on Spark
built-ins. Sub-packages:

* ``sources``   — file discovery, CSV / workbook ingest with row lineage, catalog
* ``functions`` — column expressions (types, dates, financial years, JSON)
* ``operators`` — intervals (gaps-and-islands), aggregations, joins, filters,
                  reshapes, shift/leave rules, lineage, data-quality tests
* ``plans``     — compositions: the remediation report, dataset builds, stage runner
* ``streaming`` — incremental bronze ingest with Structured Streaming
"""

from effdated.session import get_session

__all__ = ["get_session"]
__version__ = "0.1.0"
