"""punctua — a Spark-native lakehouse toolkit for flight-punctuality style data.

Every operator is an ordinary DataFrame / Structured Streaming transformation:
they take DataFrames (or paths) and return DataFrames, so Catalyst sees one
plan end to end and can prune, push down and pick join strategies itself.

Sub-packages
------------
sources     file ingestion (landing -> bronze), column-name sanitising, schema registry
functions   column expressions (parsing, hashing, delays, link extraction, array zipping)
operators   relational building blocks (standardise, quality, dedup, upsert, SCD2,
            time-series joins/fills, planning, dimensions, statistics)
plans       the query catalogue over the driver tables + their DuckDB oracles
streaming   silver streams (watermarked dedup, valid/quarantine split) and bronze runner
"""

from punctua.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
