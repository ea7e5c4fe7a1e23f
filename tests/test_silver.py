"""Bronze -> silver streams: typing, sentinels, rules, quarantine, watermark
dedup (incl. late data and the validate/dedup order), airports full refresh."""

import dataclasses
import json

from pyspark.sql import functions as F

from conftest import write
from punctua.plans.domain import AIRPORTS, BCB, VRA, WEATHER, airports_source, bcb_source, vra_source, weather_source
from punctua.sources.ingest import run_bronze
from punctua.streaming.silver import dropped_late_rows, read_silver, run_silver_batch, run_silver_stream
from test_ingest import VRA_HEADER, vra_row

PRE = "Atualizado em 2023-02-01"


def _vra_file(landing, name, rows):
    return write(f"{landing}/vra/{name}", "\n".join([PRE, VRA_HEADER] + rows) + "\n")


def _run(spark, tmp, table=VRA, src=vra_source, ck="silver_vra"):
    landing, system, bronze, silver = f"{tmp}/landing", f"{tmp}/system", f"{tmp}/bronze", f"{tmp}/silver"
    cfg = src(landing, system, bronze)
    run_bronze(spark, cfg)
    q = run_silver_stream(spark, cfg.places.bronze, table, silver, f"{system}/checkpoints/{ck}")
    return q, silver


def test_vra_typing_rules_and_quarantine(spark, tmp):
    landing = f"{tmp}/landing"
    t = "2023-01-10 10:00:00"
    rows = [
        vra_row("AZU", "1", "SBKP", t, "2023-01-10 08:00:00", t, t),             # delay -120: plausible
        vra_row("AZU", "2", "SBKP", t, "2023-01-10 07:59:00", t, t),             # delay -121: warn only
        vra_row("AZU", "3", "SBKP", t, "2023-01-11 10:00:00", t, t),             # delay 1440
        vra_row("AZU", "4", "SBKP", t, "2023-01-11 10:01:00", t, t),             # delay 1441
        vra_row("GLO", "5", "SBGR", t, "null", t, "null", "CANCELADO", "XS"),    # cancelled, text null
        vra_row("GLO", "6", "SBGR", "2023-13-40 99:00:00", t, t, t),             # unparsable planned time
        vra_row("GLO", "x7", "SBGR", t, t, t, t),                                # non-numeric flight number
        vra_row("TAM", "8", "", t, t, t, t),                                     # empty origin -> NULL
        vra_row("TAM", "9", "SBGR", t, t, t, t),
        vra_row("TAM", "9", "SBGR", t, t, t, t),                                 # exact duplicate
    ]
    _vra_file(landing, "2023/01/VRA_2023_01.csv", rows)
    q, silver = _run(spark, tmp)
    v = read_silver(spark, silver, "vra")
    qa = read_silver(spark, silver, "vra_quarantine")
    assert v.count() == 6
    assert qa.count() == 3
    by = {r["numero_voo"]: r for r in v.collect()}
    assert by[1]["atraso_partida_min"] == -120.0
    assert by[4]["atraso_partida_min"] == 1441.0
    assert by[5]["cancelado"] is True and by[5]["partida_real"] is None
    assert by[5]["codigo_justificativa"] == "XS" and by[1]["codigo_justificativa"] is None
    assert by[1]["cancelado"] is False
    assert dict(v.dtypes)["partida_prevista"] == "timestamp" and dict(v.dtypes)["numero_voo"] == "int"
    reasons = sorted(tuple(r["_failed_rules"]) for r in qa.collect())
    assert reasons == [("tem_aerodromo_origem",), ("tem_numero_voo",), ("tem_partida_prevista",)]
    # valid + quarantine partition the deduplicated input
    assert "_rescued_data" in v.columns and "_metadata" not in v.columns and "_row_hash" not in v.columns
    mt = read_silver(spark, silver, "vra_dq_metrics").groupBy("rule").agg(F.sum("passed").alias("p"),
                                                                          F.sum("failed").alias("f"))
    m = {r["rule"]: (r["p"], r["f"]) for r in mt.collect()}
    assert m["tem_numero_voo"] == (8, 1) and m["tem_aerodromo_origem"] == (8, 1)
    assert m["atraso_partida_plausivel"] == (7, 2)          # -121 and 1441 only warn


def test_duplicates_in_later_file_and_late_month(spark, tmp):
    landing = f"{tmp}/landing"
    _vra_file(landing, "2023/03/VRA_2023_03.csv", [
        vra_row("AZU", "1", "SBKP", "2023-03-10 10:00:00", "2023-03-10 10:05:00", "2023-03-10 11:00:00",
                "2023-03-10 11:00:00")])
    q, silver = _run(spark, tmp)
    assert read_silver(spark, silver, "vra").count() == 1
    _vra_file(landing, "2023/03/VRA_2023_03_fix.csv", [
        vra_row("AZU", "1", "SBKP", "2023-03-10 10:00:00", "2023-03-10 10:30:00", "2023-03-10 11:00:00",
                "2023-03-10 11:00:00"),                                               # same key, later file
        vra_row("AZU", "2", "SBKP", "2023-03-11 10:00:00", "2023-03-11 10:05:00", "2023-03-11 11:00:00",
                "2023-03-11 11:00:00")])
    _vra_file(landing, "2023/01/VRA_2023_01.csv", [
        vra_row("AZU", "7", "SBKP", "2023-01-05 10:00:00", "2023-01-05 10:05:00", "2023-01-05 11:00:00",
                "2023-01-05 11:00:00")])                                              # older than watermark
    q, silver = _run(spark, tmp)
    v = read_silver(spark, silver, "vra")
    got = sorted((r["numero_voo"], r["atraso_partida_min"]) for r in v.collect())
    assert got == [(1, 5.0), (2, 5.0)]          # first arrival wins; the January row is late
    assert read_silver(spark, silver, "vra_quarantine").filter(F.col("numero_voo") == 7).count() == 0
    assert dropped_late_rows(q) == 1
    from punctua.streaming.silver import late_rows
    late = late_rows(spark, f"{tmp}/bronze/vra", VRA, silver).collect()
    assert [(r["numero_voo"], str(r["partida_prevista"])) for r in late] == [(7, "2023-01-05 10:00:00")]


def _h1(spark, tmp, table):
    landing = f"{tmp}/landing"
    t = "2023-05-10 10:00:00"
    _vra_file(landing, "2023/05/a.csv", [vra_row("AZU", "1", "", t, t, t, t)])
    _run(spark, tmp, table)
    _vra_file(landing, "2023/05/b.csv", [vra_row("AZU", "1", "SBKP", t, t, t, t)])
    q, silver = _run(spark, tmp, table)
    return read_silver(spark, silver, "vra").count(), read_silver(spark, silver, "vra_quarantine").count()


def test_invalid_first_arrival_does_not_hide_valid_row(spark, tmp):
    assert _h1(spark, tmp, VRA) == (1, 1)


def test_dedup_first_reproduces_reference_order(spark, tmp):
    assert _h1(spark, tmp, dataclasses.replace(VRA, dedup_first=True)) == (0, 1)


def test_bcb_series(spark, tmp):
    landing = f"{tmp}/landing"
    write(f"{landing}/bcb/codigo=1/a.json", "\n".join(json.dumps(r) for r in [
        {"codigo": 1, "data": "05/01/2024", "valor": "4.85"},
        {"codigo": 1, "data": "31/02/2024", "valor": "4.90"},
        {"codigo": 1, "data": "05/01/2024", "valor": "4.85"}]))
    write(f"{landing}/bcb/codigo=999/a.json", json.dumps({"codigo": 999, "data": "08/01/2024", "valor": "1,5"}))
    write(f"{landing}/bcb/codigo=433/a.json", json.dumps({"codigo": 433, "data": "01/01/2024", "valor": "0.42"}))
    q, silver = _run(spark, tmp, BCB, bcb_source, "silver_bcb")
    v = {(r["codigo"], str(r["data"])): r for r in read_silver(spark, silver, "bcb").collect()}
    assert set(v) == {(1, "2024-01-05"), (999, "2024-01-08"), (433, "2024-01-01")}
    assert v[(1, "2024-01-05")]["serie_nome"] == "dolar_venda"
    assert v[(999, "2024-01-08")]["serie_nome"] == "999" and v[(999, "2024-01-08")]["valor"] is None
    assert v[(433, "2024-01-01")]["serie_nome"] == "ipca"
    assert read_silver(spark, silver, "bcb_quarantine").count() == 1   # 31/02 -> NULL date


def test_weather(spark, tmp):
    landing = f"{tmp}/landing"
    rows = [{"icao": "SBGR", "time": "2024-01-01T00:00", "temperature_2m": 20.0, "precipitation": 1.5,
             "wind_speed_10m": 5, "cloud_cover": 10, "visibility": None},
            {"icao": "SBGR", "time": None, "temperature_2m": 21.0, "precipitation": 0.0,
             "wind_speed_10m": 5, "cloud_cover": 10, "visibility": None}]
    write(f"{landing}/open_meteo/icao=SBGR/a.json", "\n".join(json.dumps(r) for r in rows))
    write(f"{landing}/open_meteo/icao=SBGR/b.json", json.dumps(rows[0]))   # same hour in a second file
    q, silver = _run(spark, tmp, WEATHER, weather_source, "silver_weather")
    v = read_silver(spark, silver, "clima_aeroporto_hora")
    assert v.count() == 1
    r = v.collect()[0]
    assert r["precipitacao_mm"] == 1.5 and str(r["data_hora"]) == "2024-01-01 00:00:00"
    assert "visibility" not in v.columns and "_rescued_data" not in v.columns
    assert read_silver(spark, silver, "clima_aeroporto_hora_quarantine").count() == 1


def test_airports_latest_snapshot(spark, tmp):
    landing, system, bronze, silver = f"{tmp}/landing", f"{tmp}/system", f"{tmp}/bronze", f"{tmp}/silver"
    head = ("id,type,name,latitude_deg,longitude_deg,elevation_ft,continent,iso_country,iso_region,municipality,"
            "scheduled_service,icao_code,iata_code,gps_code,local_code,home_link,wikipedia_link,keywords")
    write(f"{landing}/ourairports/dt=2024-01-01/airports.csv", "\n".join([
        head,
        "1,large_airport,Old Name,-23.4,-46.4,2459,SA,BR,BR-SP,Guarulhos,yes,SBGR,GRU,SBGR,,,,",
        "2,closed,Closed Field,-10,-50,100,SA,BR,BR-MT,X,no,SNXX,,,,,,",
        "3,small_airport,No Icao,-11,-51,abc,SA,BR,BR-MT,Y,,,,,,,,"]) + "\n")
    write(f"{landing}/ourairports/dt=2024-01-02/airports.csv", "\n".join([
        head, "1,large_airport,New Name,-23.4,-46.4,2459,SA,BR,BR-SP,Guarulhos,yes,SBGR,GRU,SBGR,,,,"]) + "\n")
    cfg = airports_source(landing, system, bronze)
    run_bronze(spark, cfg)
    run_silver_batch(spark, cfg.places.bronze, AIRPORTS, silver)
    v = {r["id_aeroporto"]: r for r in read_silver(spark, silver, "aeroporto").collect()}
    assert set(v) == {"1", "2"}
    assert v["1"]["nome"] == "New Name" and v["1"]["servico_regular"] is True
    assert v["2"]["servico_regular"] is False and v["2"]["tipo_aerodromo"] == "closed"
    q = read_silver(spark, silver, "aeroporto_quarantine").collect()
    assert len(q) == 1 and q[0]["servico_regular"] is None and q[0]["elevation_ft"] is None
    assert "home_link" not in read_silver(spark, silver, "aeroporto").columns


def test_backfill_recovers_rows_the_watermark_dropped(spark, tmp):
    from punctua.streaming.silver import backfill_silver
    landing = f"{tmp}/landing"
    _vra_file(landing, "2023/03/VRA_2023_03.csv", [
        vra_row("AZU", "1", "SBKP", "2023-03-10 10:00:00", "2023-03-10 10:05:00", "2023-03-10 11:00:00",
                "2023-03-10 11:00:00")])
    _run(spark, tmp)
    _vra_file(landing, "2023/02/VRA_2023_02.csv", [
        vra_row("AZU", "1", "SBKP", "2023-02-10 10:00:00", "2023-02-10 10:05:00", "2023-02-10 11:00:00",
                "2023-02-10 11:00:00"),
        vra_row("AZU", "1", "SBKP", "2023-03-10 10:00:00", "2023-03-10 10:09:00", "2023-03-10 11:00:00",
                "2023-03-10 11:00:00"),                     # key already in silver: not inserted twice
        vra_row("AZU", "2", "", "2023-02-11 10:00:00", "2023-02-11 10:05:00", "2023-02-11 11:00:00",
                "2023-02-11 11:00:00")])
    q, silver = _run(spark, tmp)
    assert read_silver(spark, silver, "vra").count() == 1            # February is late for the stream
    bronze = f"{tmp}/bronze/vra"
    got = backfill_silver(spark, bronze, VRA, silver, "_source_file LIKE '%/2023/02/%'", "007")
    assert got == (1, 1)
    again = backfill_silver(spark, bronze, VRA, silver, "_source_file LIKE '%/2023/02/%'", "007")
    assert again == (1, 1)                                            # idempotent per label
    v = read_silver(spark, silver, "vra")
    assert sorted((str(r["partida_prevista"]), r["atraso_partida_min"]) for r in v.collect()) == [
        ("2023-02-10 10:00:00", 5.0), ("2023-03-10 10:00:00", 5.0)]


def test_fail_rule_stops_the_run_before_writing(spark, tmp):
    import os
    from punctua.operators.quality import Expectation
    landing = f"{tmp}/landing"
    t = "2023-06-10 10:00:00"
    _vra_file(landing, "2023/06/a.csv", [vra_row("AZU", "1", "SBKP", t, t, t, t),
                                         vra_row("AZU", "2", "SBKP", t, t, t, t, sit="DESCONHECIDO")])
    strict = dataclasses.replace(VRA, rules=list(VRA.rules) + [
        Expectation("situacao_conhecida", "situacao_voo IN ('REALIZADO', 'CANCELADO')", "fail")])
    try:
        _run(spark, tmp, strict)
        raise AssertionError("expected the run to fail")
    except Exception as e:  # noqa: BLE001
        assert "situacao_conhecida" in str(e)
    assert not os.path.exists(f"{tmp}/silver/vra")


def test_stream_equals_batch_twin_on_in_order_data(spark, tmp):
    """Files arriving in event-time order: the streaming silver table equals the batch twin.

    (Rows whose event time is NULL are excluded by construction: a stream deduplicates
    them only within a micro-batch.)"""
    landing = f"{tmp}/landing"
    for m in (1, 2, 3):
        rows = []
        for d in ("05", "15", "25"):
            t = f"2023-0{m}-{d} 10:00:00"
            rows += [vra_row("AZU", str(n), "SBKP" if n % 4 else "", t, f"2023-0{m}-{d} 10:0{n}:00", t, t)
                     for n in range(1, 6)]
            rows.append(vra_row("AZU", "1", "SBKP", t, f"2023-0{m}-{d} 11:00:00", t, t))   # duplicate key
        _vra_file(landing, f"2023/0{m}/VRA_2023_0{m}.csv", rows)
        q, silver = _run(spark, tmp)
    batch_out = f"{tmp}/silver_batch"
    run_silver_batch(spark, f"{tmp}/bronze/vra", VRA, batch_out)
    cols = ["icao_companhia", "numero_voo", "partida_prevista", "atraso_partida_min"]
    for name in ("vra", "vra_quarantine"):
        a = sorted((tuple(map(str, r)) for r in read_silver(spark, silver, name).select(*cols).collect()))
        b = sorted((tuple(map(str, r)) for r in read_silver(spark, batch_out, name).select(*cols).collect()))
        assert a == b and len(a) > 0, name
