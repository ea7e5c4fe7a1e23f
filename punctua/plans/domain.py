"""The four source feeds of the punctuality lakehouse: bronze source configs
and silver table definitions (names, types, keys, watermarks, rules).

Silver column names, sentinels, formats, codes and rules below are the data
contract of the feeds and are fixed values.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from punctua.functions.columns import FLIGHT_TS_FORMAT, SERIES_DATE_FORMAT, minutes_between
from punctua.operators.quality import Expectation
from punctua.operators.standardize import StandardizeSpec
from punctua.sources.ingest import Feed, feed
from punctua.streaming.silver import SilverTable

# --------------------------------------------------------------------------- fixed values
# Flights (monthly CSV, ';'-separated, one preamble line before the header).
VRA_RENAMES = {
    "icao_empresa_aérea": "icao_companhia",
    "número_voo": "numero_voo",
    "código_autorização_di": "codigo_autorizacao_di",
    "código_tipo_linha": "codigo_tipo_linha",
    "icao_aeródromo_origem": "icao_aerodromo_origem",
    "icao_aeródromo_destino": "icao_aerodromo_destino",
    "situação_voo": "situacao_voo",
    "código_justificativa": "codigo_justificativa",
}
VRA_TIMESTAMPS = ["partida_prevista", "partida_real", "chegada_prevista", "chegada_real"]
VRA_REAL_TIMES = ["partida_real", "chegada_real"]
VRA_KEY = ["icao_companhia", "numero_voo", "partida_prevista"]
VRA_CANCELLED = "CANCELADO"

# Economic series (JSON Lines under codigo=<n>/).
BCB_LABELS = {1: "dolar_venda", 10813: "dolar_compra", 433: "ipca"}
BCB_KEY = ["codigo", "data"]

# Hourly weather (JSON Lines under icao=<ICAO>/).
WEATHER_RENAMES = {
    "time": "data_hora",
    "temperature_2m": "temperatura_c",
    "precipitation": "precipitacao_mm",
    "wind_speed_10m": "vento_kmh",
    "cloud_cover": "cobertura_nuvens_pct",
}
WEATHER_DOUBLES = ["temperatura_c", "precipitacao_mm", "vento_kmh", "cobertura_nuvens_pct"]
WEATHER_KEY = ["icao", "data_hora"]

# Airports (daily CSV snapshot under dt=YYYY-MM-DD/).
AIRPORT_RENAMES = {
    "id": "id_aeroporto",
    "type": "tipo_aerodromo",
    "name": "nome",
    "latitude_deg": "latitude",
    "longitude_deg": "longitude",
    "continent": "continente",
    "iso_country": "pais_iso",
    "iso_region": "regiao_iso",
    "municipality": "municipio",
    "scheduled_service": "servico_regular",
    "icao_code": "icao",
    "iata_code": "iata",
    "gps_code": "codigo_gps",
    "local_code": "codigo_local",
}
AIRPORT_DROPS = ["_metadata", "_row_hash", "home_link", "wikipedia_link", "keywords"]

LINEAGE_DROPS = ["_metadata", "_row_hash"]


# --------------------------------------------------------------------------- bronze configs
def vra_source(landing: str, system: str, bronze: str) -> Feed:
    return feed(f"{landing}/vra", f"{system}/checkpoints/vra", f"{bronze}/vra", "csv",
                        options={"sep": ";", "quote": '"', "encoding": "UTF-8"}, preamble=1)


def bcb_source(landing: str, system: str, bronze: str) -> Feed:
    return feed(f"{landing}/bcb", f"{system}/checkpoints/bcb", f"{bronze}/bcb", "json")


def weather_source(landing: str, system: str, bronze: str) -> Feed:
    return feed(f"{landing}/open_meteo", f"{system}/checkpoints/open_meteo", f"{bronze}/open_meteo", "json")


def airports_source(landing: str, system: str, bronze: str) -> Feed:
    return feed(f"{landing}/ourairports", f"{system}/checkpoints/ourairports", f"{bronze}/ourairports",
                        "csv", options={"sep": ",", "quote": '"'})


# --------------------------------------------------------------------------- silver tables
VRA = SilverTable(
    name="vra",
    spec=StandardizeSpec(
        renames=VRA_RENAMES,
        drops=LINEAGE_DROPS,
        sentinels={**{c: "null" for c in VRA_REAL_TIMES}, "codigo_justificativa": "N/A"},
        timestamps={c: FLIGHT_TS_FORMAT for c in VRA_TIMESTAMPS},
        casts={"numero_voo": "int", "codigo_autorizacao_di": "int"},
        derived={
            "atraso_partida_min": lambda: minutes_between("partida_real", "partida_prevista"),
            "atraso_chegada_min": lambda: minutes_between("chegada_real", "chegada_prevista"),
            "cancelado": lambda: F.col("situacao_voo") == F.lit(VRA_CANCELLED),
        },
    ),
    keys=VRA_KEY,
    rules=[
        Expectation("tem_numero_voo", "numero_voo IS NOT NULL", "drop"),
        Expectation("tem_companhia", "icao_companhia IS NOT NULL", "drop"),
        Expectation("tem_aerodromo_origem", "icao_aerodromo_origem IS NOT NULL", "drop"),
        Expectation("tem_partida_prevista", "partida_prevista IS NOT NULL", "drop"),
        Expectation("atraso_partida_plausivel",
                    "atraso_partida_min IS NULL OR atraso_partida_min BETWEEN -120 AND 1440", "warn"),
    ],
    event_time="partida_prevista",
    watermark="3 days",
)

BCB = SilverTable(
    name="bcb",
    spec=StandardizeSpec(
        drops=LINEAGE_DROPS,
        dates={"data": SERIES_DATE_FORMAT},
        casts={"valor": "double", "codigo": "int"},
        labels={"serie_nome": ("codigo", BCB_LABELS)},
    ),
    keys=BCB_KEY,
    rules=[Expectation("tem_codigo", "codigo IS NOT NULL", "drop"),
           Expectation("tem_data", "data IS NOT NULL", "drop")],
    event_time="data",
    watermark="30 days",
)

WEATHER = SilverTable(
    name="clima_aeroporto_hora",
    spec=StandardizeSpec(
        renames=WEATHER_RENAMES,
        drops=LINEAGE_DROPS + ["_rescued_data", "visibility"],
        timestamps={"data_hora": None},
        casts={c: "double" for c in WEATHER_DOUBLES},
    ),
    keys=WEATHER_KEY,
    rules=[Expectation("tem_icao", "icao IS NOT NULL", "drop"),
           Expectation("tem_data_hora", "data_hora IS NOT NULL", "drop")],
    event_time="data_hora",
    watermark="3 days",
)

AIRPORTS = SilverTable(
    name="aeroporto",
    spec=StandardizeSpec(
        renames=AIRPORT_RENAMES,
        drops=AIRPORT_DROPS,
        casts={"latitude": "double", "longitude": "double", "elevation_ft": "int"},
        flags={"servico_regular": ("servico_regular", "yes")},
    ),
    keys=["id_aeroporto"],
    rules=[Expectation("tem_icao", "icao IS NOT NULL", "drop"),
           Expectation("aerodromo_fechado_sinalizado", "tipo_aerodromo != 'closed'", "warn")],
    latest_order=(lambda: F.col("dt").desc(),),
    dedup_first=True,
)
