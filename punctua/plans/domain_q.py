"""The four silver tables of the feeds, run on whole driver tables.

Each query builds a bronze-shaped frame (raw text columns under the feed's
raw names, ``_source_file``/``_ingested_at`` lineage) from the driver tables
and applies the feed's own silver definition from :mod:`punctua.plans.domain`
in batch mode: standardise -> validate -> dedup (first arrival, i.e. ingest
time then file path; snapshot date for airports) -> valid / quarantine.

Made-bad values (non-numeric flight numbers, impossible dates, missing
codes) are derived from the keys so that every rule fires at every scale.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from punctua.plans.domain import AIRPORTS, BCB, VRA, WEATHER
from punctua.plans.registry import query
from punctua.streaming.silver import silver_frame, split_outputs
from punctua.tables import Tables

INGESTED_AT = "2024-06-01 00:00:00"
TS_FMT = "yyyy-MM-dd HH:mm:ss"


def _pad(c, n):
    return F.lpad(F.col(c).cast("string"), n, "0")


def vra_bronze(t: Tables):
    li = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus",
                           "l_shipdate")
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    s = t.supplier.select("s_suppkey", "s_nationkey")
    c = t.customer.select("c_custkey", "c_nationkey")
    j = (li.join(o, li.l_orderkey == o.o_orderkey).join(s, li.l_suppkey == s.s_suppkey)
         .join(c, o.o_custkey == c.c_custkey))
    planned = F.col("o_orderdate") + F.make_interval(hours=(F.col("l_orderkey") % 24).cast("int"))
    real = F.col("l_shipdate") + F.make_interval(mins=(F.col("l_partkey") % 90).cast("int"))
    cancelled = F.col("o_orderstatus") == "P"
    return j.select(
        F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.col("o_orderpriority")).alias("icao_empresa_aérea"),
        F.when(F.col("l_partkey") % 50 == 0, F.concat(F.lit("x"), F.col("l_linenumber").cast("string")))
        .otherwise(F.col("l_linenumber").cast("string")).alias("número_voo"),
        F.col("l_suppkey").cast("string").alias("código_autorização_di"),
        F.col("l_returnflag").alias("código_tipo_linha"),
        F.when(F.col("s_nationkey") != 0, F.concat(F.lit("N"), F.col("s_nationkey").cast("string")))
        .alias("icao_aeródromo_origem"),
        F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("icao_aeródromo_destino"),
        F.when(F.col("l_partkey") % 61 == 0, F.lit("2024-13-01 25:00:00"))
        .otherwise(F.date_format(planned, TS_FMT)).alias("partida_prevista"),
        F.when(cancelled, F.lit("null")).otherwise(F.date_format(real, TS_FMT)).alias("partida_real"),
        F.date_format(planned + F.make_interval(hours=F.lit(2)), TS_FMT).alias("chegada_prevista"),
        F.when(cancelled, F.lit("null"))
        .otherwise(F.date_format(real + F.make_interval(hours=F.lit(2)), TS_FMT)).alias("chegada_real"),
        F.when(cancelled, F.lit("CANCELADO")).otherwise(F.lit("REALIZADO")).alias("situação_voo"),
        F.when(F.col("l_returnflag") == "N", F.lit("N/A")).otherwise(F.col("l_linestatus"))
        .alias("código_justificativa"),
        F.concat(F.lit("vra/"), F.date_format("o_orderdate", "yyyy/MM"), F.lit("/f_"), _pad("l_orderkey", 10),
                 F.lit("_"), _pad("l_linenumber", 3), F.lit("_"), _pad("l_partkey", 10), F.lit("_"),
                 F.date_format("l_shipdate", "yyyyMMdd"), F.lit(".csv")).alias("_source_file"),
        F.lit(INGESTED_AT).cast("timestamp").alias("_ingested_at"),
    )


_VRA_BRONZE_SQL = """
b AS (
  SELECT CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_orderpriority END AS "icao_empresa_aérea",
         CASE WHEN l_partkey % 50 = 0 THEN 'x' || CAST(l_linenumber AS VARCHAR) ELSE CAST(l_linenumber AS VARCHAR) END
           AS "número_voo",
         CAST(l_suppkey AS VARCHAR) AS "código_autorização_di",
         l_returnflag AS "código_tipo_linha",
         CASE WHEN s_nationkey <> 0 THEN 'N' || CAST(s_nationkey AS VARCHAR) END AS "icao_aeródromo_origem",
         'N' || CAST(c_nationkey AS VARCHAR) AS "icao_aeródromo_destino",
         CASE WHEN l_partkey % 61 = 0 THEN '2024-13-01 25:00:00'
              ELSE strftime(o_orderdate + to_hours(CAST(l_orderkey % 24 AS INTEGER)), '%Y-%m-%d %H:%M:%S') END
           AS partida_prevista,
         CASE WHEN o_orderstatus = 'P' THEN 'null'
              ELSE strftime(l_shipdate + to_minutes(CAST(l_partkey % 90 AS INTEGER)), '%Y-%m-%d %H:%M:%S') END
           AS partida_real,
         strftime(o_orderdate + to_hours(CAST(l_orderkey % 24 AS INTEGER)) + INTERVAL 2 HOUR, '%Y-%m-%d %H:%M:%S')
           AS chegada_prevista,
         CASE WHEN o_orderstatus = 'P' THEN 'null'
              ELSE strftime(l_shipdate + to_minutes(CAST(l_partkey % 90 AS INTEGER)) + INTERVAL 2 HOUR,
                            '%Y-%m-%d %H:%M:%S') END AS chegada_real,
         CASE WHEN o_orderstatus = 'P' THEN 'CANCELADO' ELSE 'REALIZADO' END AS "situação_voo",
         CASE WHEN l_returnflag = 'N' THEN 'N/A' ELSE l_linestatus END AS "código_justificativa",
         'vra/' || strftime(o_orderdate, '%Y/%m') || '/f_' || lpad(CAST(l_orderkey AS VARCHAR), 10, '0') || '_' ||
           lpad(CAST(l_linenumber AS VARCHAR), 3, '0') || '_' || lpad(CAST(l_partkey AS VARCHAR), 10, '0') || '_' ||
           strftime(l_shipdate, '%Y%m%d') || '.csv' AS _source_file
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey
  JOIN customer ON o_custkey = c_custkey
),
s AS (
  SELECT "icao_empresa_aérea" AS icao_companhia, TRY_CAST("número_voo" AS INTEGER) AS numero_voo,
         TRY_CAST("código_autorização_di" AS INTEGER) AS codigo_autorizacao_di,
         "icao_aeródromo_origem" AS icao_aerodromo_origem, "icao_aeródromo_destino" AS icao_aerodromo_destino,
         try_strptime(partida_prevista, '%Y-%m-%d %H:%M:%S') AS partida_prevista,
         try_strptime(nullif(partida_real, 'null'), '%Y-%m-%d %H:%M:%S') AS partida_real,
         try_strptime(chegada_prevista, '%Y-%m-%d %H:%M:%S') AS chegada_prevista,
         try_strptime(nullif(chegada_real, 'null'), '%Y-%m-%d %H:%M:%S') AS chegada_real,
         "situação_voo" AS situacao_voo, nullif("código_justificativa", 'N/A') AS codigo_justificativa, _source_file
  FROM b
),
d AS (
  SELECT *, (floor(epoch(partida_real)) - floor(epoch(partida_prevista))) / 60.0 AS atraso_partida_min,
         (floor(epoch(chegada_real)) - floor(epoch(chegada_prevista))) / 60.0 AS atraso_chegada_min,
         situacao_voo = 'CANCELADO' AS cancelado,
         coalesce(numero_voo IS NOT NULL, false) AND coalesce(icao_companhia IS NOT NULL, false)
           AND coalesce(icao_aerodromo_origem IS NOT NULL, false) AND coalesce(partida_prevista IS NOT NULL, false)
           AS valid,
         concat_ws(',', CASE WHEN numero_voo IS NULL THEN 'tem_numero_voo' END,
                        CASE WHEN icao_companhia IS NULL THEN 'tem_companhia' END,
                        CASE WHEN icao_aerodromo_origem IS NULL THEN 'tem_aerodromo_origem' END,
                        CASE WHEN partida_prevista IS NULL THEN 'tem_partida_prevista' END) AS failed_rules
  FROM s
),
r AS (
  SELECT *, row_number() OVER (PARTITION BY icao_companhia, numero_voo, partida_prevista, valid
                               ORDER BY _source_file) AS rn_
  FROM d
)"""

_VRA_COLS = ("icao_companhia, numero_voo, codigo_autorizacao_di, icao_aerodromo_origem, icao_aerodromo_destino, "
             "partida_prevista, partida_real, chegada_prevista, chegada_real, situacao_voo, codigo_justificativa, "
             "round(atraso_partida_min, 6) AS atraso_partida_min, round(atraso_chegada_min, 6) AS atraso_chegada_min, "
             "cancelado, _source_file")


def _vra_select(df, *extra):
    return df.select(*extra, "icao_companhia", "numero_voo", "codigo_autorizacao_di", "icao_aerodromo_origem",
                     "icao_aerodromo_destino", "partida_prevista", "partida_real", "chegada_prevista", "chegada_real",
                     "situacao_voo", "codigo_justificativa", F.round("atraso_partida_min", 6).alias("atraso_partida_min"),
                     F.round("atraso_chegada_min", 6).alias("atraso_chegada_min"), "cancelado", "_source_file")


@query("silver_vra", sql=f"WITH {_VRA_BRONZE_SQL} SELECT {_VRA_COLS} FROM r WHERE rn_ = 1 AND valid")
def q_silver_vra(spark: SparkSession, sf_dir: str):
    """Flights silver table: typed, sentinel-cleaned, delays, validated, deduplicated."""
    valid, _ = split_outputs(silver_frame(vra_bronze(Tables(spark, sf_dir)), VRA), VRA)
    return _vra_select(valid)


@query("silver_vra_quarantine",
       sql=f"WITH {_VRA_BRONZE_SQL} SELECT {_VRA_COLS}, failed_rules FROM r WHERE rn_ = 1 AND NOT valid")
def q_silver_vra_quarantine(spark: SparkSession, sf_dir: str):
    """Flights that fail a blocking rule, with the rules they fail."""
    _, quarantine = split_outputs(silver_frame(vra_bronze(Tables(spark, sf_dir)), VRA), VRA)
    return _vra_select(quarantine.withColumn("failed_rules", F.concat_ws(",", "_failed_rules")), "failed_rules")


# --------------------------------------------------------------------------- series
def bcb_bronze(t: Tables):
    e = t.events.select("event_id", "ts", "event_type", "value")
    code = (F.when(F.col("event_type") == "purchase", F.lit("1")).when(F.col("event_type") == "view", F.lit("10813"))
            .when(F.col("event_type") == "click", F.lit("433")).when(F.col("event_type") == "signup", F.lit("999")))
    return e.select(
        code.alias("codigo"),
        F.when(F.col("event_id") % 97 == 0, F.lit("31/02/2024")).otherwise(F.date_format("ts", "dd/MM/yyyy"))
        .alias("data"),
        F.when(F.col("event_id") % 89 == 0, F.lit("n/d")).otherwise(F.col("value").cast("string")).alias("valor"),
        F.concat(F.lit("bcb/codigo="), F.coalesce(code, F.lit("x")), F.lit("/"), _pad("event_id", 12),
                 F.lit(".json")).alias("_source_file"),
        F.lit(INGESTED_AT).cast("timestamp").alias("_ingested_at"),
    )


@query("silver_bcb", sql="""
WITH b AS (
  SELECT CASE event_type WHEN 'purchase' THEN '1' WHEN 'view' THEN '10813' WHEN 'click' THEN '433'
                         WHEN 'signup' THEN '999' END AS codigo_txt,
         CASE WHEN event_id % 97 = 0 THEN '31/02/2024' ELSE strftime(ts, '%d/%m/%Y') END AS data_txt,
         CASE WHEN event_id % 89 = 0 THEN 'n/d' ELSE CAST(value AS VARCHAR) END AS valor_txt, event_id
  FROM events),
s AS (
  SELECT TRY_CAST(codigo_txt AS INTEGER) AS codigo, CAST(try_strptime(data_txt, '%d/%m/%Y') AS DATE) AS data,
         TRY_CAST(valor_txt AS DOUBLE) AS valor,
         'bcb/codigo=' || coalesce(codigo_txt, 'x') || '/' || lpad(CAST(event_id AS VARCHAR), 12, '0') || '.json'
           AS _source_file
  FROM b),
d AS (
  SELECT *, CASE codigo WHEN 1 THEN 'dolar_venda' WHEN 10813 THEN 'dolar_compra' WHEN 433 THEN 'ipca'
                        ELSE CAST(codigo AS VARCHAR) END AS serie_nome,
         coalesce(codigo IS NOT NULL, false) AND coalesce(data IS NOT NULL, false) AS valid
  FROM s),
r AS (SELECT *, row_number() OVER (PARTITION BY codigo, data, valid ORDER BY _source_file) AS rn_ FROM d)
SELECT codigo, data, round(valor, 6) AS valor, serie_nome, _source_file FROM r WHERE rn_ = 1 AND valid
""")
def q_silver_bcb(spark: SparkSession, sf_dir: str):
    """Economic series silver table: dd/MM/yyyy dates, code labels, one value per (code, day)."""
    valid, _ = split_outputs(silver_frame(bcb_bronze(Tables(spark, sf_dir)), BCB), BCB)
    return valid.select("codigo", "data", F.round("valor", 6).alias("valor"), "serie_nome", "_source_file")


# --------------------------------------------------------------------------- weather
def weather_bronze(t: Tables, *more: Column):
    """Bronze-shaped hourly weather; ``more``: further columns over ``events``."""
    e = t.events.select("event_id", "ts", "user_id", "event_type", "value")
    return e.select(
        F.when((F.col("event_type") == "error") & (F.col("event_id") % 3 == 0), F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("U"), F.col("user_id").cast("string"))).alias("icao"),
        F.date_format(F.date_trunc("hour", "ts"), "yyyy-MM-dd'T'HH:mm").alias("time"),
        F.col("value").cast("string").alias("temperature_2m"),
        F.when(F.col("event_type") == "purchase", F.col("value").cast("string")).otherwise(F.lit("0.0"))
        .alias("precipitation"),
        (F.col("user_id") % 40).cast("string").alias("wind_speed_10m"),
        (F.col("event_id") % 101).cast("string").alias("cloud_cover"),
        F.lit(None).cast("string").alias("visibility"),
        F.concat(F.lit("open_meteo/icao=U"), F.col("user_id").cast("string"), F.lit("/"), _pad("event_id", 12),
                 F.lit(".json")).alias("_source_file"),
        F.lit(INGESTED_AT).cast("timestamp").alias("_ingested_at"),
        F.lit(None).cast("string").alias("_rescued_data"), *more,
    )


@query("silver_weather", sql="""
WITH s AS (
  SELECT CASE WHEN event_type = 'error' AND event_id % 3 = 0 THEN NULL ELSE 'U' || CAST(user_id AS VARCHAR) END AS icao,
         date_trunc('hour', ts) AS data_hora, value AS temperatura_c,
         CASE WHEN event_type = 'purchase' THEN value ELSE 0.0 END AS precipitacao_mm,
         CAST(user_id % 40 AS DOUBLE) AS vento_kmh, CAST(event_id % 101 AS DOUBLE) AS cobertura_nuvens_pct,
         'open_meteo/icao=U' || CAST(user_id AS VARCHAR) || '/' || lpad(CAST(event_id AS VARCHAR), 12, '0') || '.json'
           AS _source_file
  FROM events),
d AS (SELECT *, coalesce(icao IS NOT NULL, false) AND coalesce(data_hora IS NOT NULL, false) AS valid FROM s),
r AS (SELECT *, row_number() OVER (PARTITION BY icao, data_hora, valid ORDER BY _source_file) AS rn_ FROM d)
SELECT icao, data_hora, round(temperatura_c, 6) AS temperatura_c, round(precipitacao_mm, 6) AS precipitacao_mm,
       vento_kmh, cobertura_nuvens_pct, _source_file
FROM r WHERE rn_ = 1 AND valid
""")
def q_silver_weather(spark: SparkSession, sf_dir: str):
    """Hourly weather silver table: ISO hour to timestamp, doubles, one reading per (airport, hour)."""
    valid, _ = split_outputs(silver_frame(weather_bronze(Tables(spark, sf_dir)), WEATHER), WEATHER)
    return valid.select("icao", "data_hora", F.round("temperatura_c", 6).alias("temperatura_c"),
                        F.round("precipitacao_mm", 6).alias("precipitacao_mm"), "vento_kmh", "cobertura_nuvens_pct",
                        "_source_file")


# --------------------------------------------------------------------------- airports
def airports_bronze(t: Tables):
    c = t.customer.select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    k = F.col("c_custkey")

    def snap(df, dt, suffix):
        dt = dt if isinstance(dt, Column) else F.lit(dt)
        return df.select(
            k.cast("string").alias("id"),
            F.when(F.col("c_mktsegment") == "BUILDING", F.lit("closed")).otherwise(F.lit("small_airport")).alias("type"),
            F.concat(F.col("c_name"), F.lit(suffix)).alias("name"),
            F.col("c_acctbal").cast("string").alias("latitude_deg"),
            F.col("c_nationkey").cast("string").alias("longitude_deg"),
            F.when(k % 37 == 0, F.lit("abc")).otherwise((F.col("c_nationkey") * 100).cast("string")).alias("elevation_ft"),
            F.lit("SA").alias("continent"), F.lit("BR").alias("iso_country"),
            F.concat(F.lit("BR-"), F.col("c_nationkey").cast("string")).alias("iso_region"),
            F.col("c_mktsegment").alias("municipality"),
            F.when(k % 3 == 0, F.lit("yes")).when(k % 3 == 1, F.lit("no")).alias("scheduled_service"),
            F.when(k % 11 != 0, F.concat(F.lit("C"), k.cast("string"))).alias("icao_code"),
            F.lit(None).cast("string").alias("iata_code"), F.lit(None).cast("string").alias("gps_code"),
            F.lit(None).cast("string").alias("local_code"), F.lit("http://x").alias("home_link"),
            F.lit(None).cast("string").alias("wikipedia_link"), F.lit(None).cast("string").alias("keywords"),
            dt.alias("dt"),
            F.concat(F.lit("ourairports/dt="), dt, F.lit("/airports.csv")).alias("_source_file"),
            F.lit(INGESTED_AT).cast("timestamp").alias("_ingested_at"),
        )
    # second download: every airport again; a quarter of them newer than the first snapshot
    second = F.when(k % 4 == 0, F.lit("2024-01-02")).otherwise(F.lit("2023-12-31"))
    return snap(c, "2024-01-01", "").unionByName(snap(c, second, " v2"))


@query("silver_airports", sql="""
WITH b AS (
  SELECT c_custkey, c_name AS name, c_nationkey, c_acctbal, c_mktsegment, '2024-01-01' AS dt FROM customer
  UNION ALL
  SELECT c_custkey, c_name || ' v2', c_nationkey, c_acctbal, c_mktsegment,
         CASE WHEN c_custkey % 4 = 0 THEN '2024-01-02' ELSE '2023-12-31' END FROM customer),
l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY dt DESC) AS rn_ FROM b) WHERE rn_ = 1)
SELECT CAST(c_custkey AS VARCHAR) AS id_aeroporto,
       CASE WHEN c_mktsegment = 'BUILDING' THEN 'closed' ELSE 'small_airport' END AS tipo_aerodromo,
       name AS nome, round(c_acctbal, 6) AS latitude, CAST(c_nationkey AS DOUBLE) AS longitude,
       CASE WHEN c_custkey % 37 = 0 THEN NULL ELSE c_nationkey * 100 END AS elevation_ft,
       CASE c_custkey % 3 WHEN 0 THEN true WHEN 1 THEN false END AS servico_regular,
       'C' || CAST(c_custkey AS VARCHAR) AS icao, dt
FROM l WHERE c_custkey % 11 <> 0
""")
def q_silver_airports(spark: SparkSession, sf_dir: str):
    """Airport dimension: latest daily snapshot per airport, typed; rows without ICAO quarantined."""
    valid, _ = split_outputs(silver_frame(airports_bronze(Tables(spark, sf_dir)), AIRPORTS), AIRPORTS)
    return valid.select("id_aeroporto", "tipo_aerodromo", "nome", F.round("latitude", 6).alias("latitude"),
                        "longitude", "elevation_ft", "servico_regular", "icao", "dt")
