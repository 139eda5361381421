"""strata: a Spark-native ELT and data-quality-gate library.

Every operator is a DataFrame-in / DataFrame-out function built from
``pyspark.sql`` built-ins, so Catalyst plans, prunes and codegens it.

Sub-packages
------------
functions  column-expression helpers (keys, null handling, bands, checksums)
operators  staging, dimensions, joins, aggregates, quality gate, publication,
           comparison
sources    file inventory, text dumps, CSV, partitioned Parquet, snapshot
           tables, raw slice loader
plans      composed jobs: the ELT candidate build, scenarios, driver-table
           feeds, registered queries and their SQL oracles
streaming  incremental late-correction processing with Structured Streaming
"""

from strata.session import build_session, shared_dir

__all__ = ["build_session", "shared_dir"]
