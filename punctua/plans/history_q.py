"""Type-2 history queries: ``events`` read as a change feed.

key = user_id, tracked attribute = event_type, sequence = event_id,
an ``error`` event = DELETE of the user's current state.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from punctua.operators.joins import point_in_time
from punctua.operators.scd2 import scd2_current_state, scd2_from_cdc
from punctua.plans.registry import query
from punctua.session import materialize
from punctua.tables import Tables

# Sequence-range bucket used to split hot keys (events per bucket of ids).
SEQ_BUCKET = 4096

_VERSIONS_SQL = """
c AS (SELECT user_id, event_id, ts, CASE WHEN event_type = 'error' THEN NULL ELSE event_type END AS s,
             lag(CASE WHEN event_type = 'error' THEN NULL ELSE event_type END)
               OVER (PARTITION BY user_id ORDER BY event_id) AS p,
             row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn
      FROM events),
k AS (SELECT * FROM c WHERE (rn = 1 AND s IS NOT NULL) OR (rn > 1 AND s IS DISTINCT FROM p)),
v AS (SELECT user_id, s AS event_type, event_id AS valid_from_seq,
             lead(event_id) OVER (PARTITION BY user_id ORDER BY event_id) AS valid_to_seq,
             ts AS valid_from_ts, lead(ts) OVER (PARTITION BY user_id ORDER BY event_id) AS valid_to_ts
      FROM k),
versions AS (SELECT *, valid_to_seq IS NULL AS is_current FROM v WHERE event_type IS NOT NULL)"""


def versions(t: Tables):
    e = t.events
    return scd2_from_cdc(e, "user_id", "event_id", "ts", ["event_type"],
                         F.col("event_type") == "error", seq_bucket=SEQ_BUCKET)


@query("scd2_history", sql=f"WITH {_VERSIONS_SQL} SELECT * FROM versions")
def q_scd2_history(spark: SparkSession, sf_dir: str):
    return versions(Tables(spark, sf_dir))


@query("scd2_current", sql=f"WITH {_VERSIONS_SQL} SELECT * FROM versions WHERE is_current")
def q_scd2_current(spark: SparkSession, sf_dir: str):
    e = Tables(spark, sf_dir).events
    return scd2_current_state(e, "user_id", "event_id", "ts", ["event_type"], F.col("event_type") == "error")


@query("scd2_point_in_time", sql=f"""
WITH {_VERSIONS_SQL}
SELECT e.event_id, e.user_id, v.event_type AS version_event_type,
       coalesce(v.valid_from_seq, -1) AS version_sk
FROM events e LEFT JOIN versions v
  ON e.user_id = v.user_id AND v.valid_from_seq <= e.event_id
 AND (v.valid_to_seq IS NULL OR e.event_id < v.valid_to_seq)
""")
def q_scd2_point_in_time(spark: SparkSession, sf_dir: str):
    """Each event joined to the user's version valid at its sequence number (-1: none)."""
    t = Tables(spark, sf_dir)
    # the history is a dimension table: written once, then joined (the as-of join reads it in two branches)
    v = materialize(versions(t), "user_history").select(F.col("user_id").alias("v_user"), F.col("event_type").alias("version_event_type"),
                           "valid_from_seq", "valid_to_seq")
    e = t.events.select("event_id", "user_id")
    j = point_in_time(e, v, "user_id", "event_id", "v_user", "valid_from_seq", "valid_to_seq",
                      bucket_size=SEQ_BUCKET)
    return j.select("event_id", "user_id", "version_event_type",
                    F.coalesce("valid_from_seq", F.lit(-1).cast("bigint")).alias("version_sk"))
