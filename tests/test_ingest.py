"""Landing -> bronze: preamble skip, sanitised names, schema evolution, rescued
data, partitions, lineage columns and exactly-once re-runs."""

import json
import os

import pytest
from pyspark.sql import functions as F

from conftest import write
from punctua.functions.columns import row_hash
from punctua.plans.domain import bcb_source, vra_source, weather_source
from punctua.sources.ingest import feed, read_bronze, run_bronze
from punctua.sources.naming import sanitize_columns, sanitize_name

VRA_HEADER = ("ICAO Empresa Aérea;Número Voo;Código Autorização (DI);Código Tipo Linha;ICAO Aeródromo Origem;"
              "ICAO Aeródromo Destino;Partida Prevista;Partida Real;Chegada Prevista;Chegada Real;Situação Voo;"
              "Código Justificativa")


def vra_row(cia, num, orig, pp, pr, cp, cr, sit="REALIZADO", just="N/A"):
    return f"{cia};{num};0;N;{orig};SBGR;{pp};{pr};{cp};{cr};{sit};{just}"


def test_sanitize_name_rules():
    assert sanitize_name(" A (b) ") == "a_b"
    assert sanitize_name("_keep me") == "_keep me"
    assert sanitize_name("Número Voo") == "número_voo"
    assert sanitize_name("Código Autorização (DI)") == "código_autorização_di"


def test_sanitize_collision_raises(spark):
    df = spark.createDataFrame([(1, 2)], "`a b` int, `a;b` int")
    try:
        sanitize_columns(df)
        raise AssertionError("expected a collision error")
    except ValueError:
        pass
    assert sanitize_columns(df, on_collision="suffix").columns == ["a_b", "a_b_2"]


def test_csv_preamble_evolution_rescue_and_rerun(spark, tmp):
    landing, system, bronze = f"{tmp}/landing", f"{tmp}/system", f"{tmp}/bronze"
    write(f"{landing}/vra/2023/01/VRA_2023_01.csv", "\n".join([
        "Atualizado em 2023-02-01",
        VRA_HEADER,
        vra_row("AZU", "4001", "SBKP", "2023-01-01 10:00:00", "2023-01-01 10:20:00", "2023-01-01 11:00:00",
                "2023-01-01 11:15:00"),
        vra_row("GLO", "1000", "SBGR", "2023-01-01 12:00:00", "null", "2023-01-01 13:00:00", "null",
                "CANCELADO", "XS"),
    ]) + "\n")
    cfg = vra_source(landing, system, bronze)
    run_bronze(spark, cfg)
    b = read_bronze(spark, bronze + "/vra")
    assert b.count() == 2
    for c in ["icao_empresa_aérea", "número_voo", "código_autorização_di", "_source_file", "_ingested_at",
              "_row_hash", "_rescued_data"]:
        assert c in b.columns, c
    # re-run without new files adds nothing
    run_bronze(spark, cfg)
    assert read_bronze(spark, bronze + "/vra").count() == 2
    # a later file with one more column (in the middle) and a row with a surplus field
    header2 = VRA_HEADER.replace("Situação Voo;", "Situação Voo;Nova Coluna;")
    write(f"{landing}/vra/2023/02/VRA_2023_02.csv", "\n".join([
        "Atualizado em 2023-03-01",
        header2,
        "AZU;4002;0;N;SBKP;SBGR;2023-02-01 10:00:00;2023-02-01 10:05:00;2023-02-01 11:00:00;"
        "2023-02-01 11:01:00;REALIZADO;extra;N/A",
        "AZU;4003;0;N;SBKP;SBGR;2023-02-01 10:00:00;2023-02-01 10:05:00;2023-02-01 11:00:00;"
        "2023-02-01 11:01:00;REALIZADO;x;N/A;SURPLUS",
    ]) + "\n")
    run_bronze(spark, cfg)
    b = read_bronze(spark, bronze + "/vra")
    assert b.count() == 4
    assert "nova_coluna" in b.columns
    rows = {r["número_voo"]: r for r in b.collect()}
    assert rows["4001"]["nova_coluna"] is None
    assert rows["4002"]["nova_coluna"] == "extra"
    assert rows["4002"]["código_justificativa"] == "N/A"
    assert rows["4003"]["_rescued_data"] == json.dumps(["SURPLUS"], separators=(",", ":"))
    assert rows["1000"]["partida_real"] == "null"
    # no preamble or header line leaked in
    assert b.filter(F.col("icao_empresa_aérea").startswith("Atualizado")).count() == 0
    assert b.filter(F.col("icao_empresa_aérea") == "ICAO Empresa Aérea").count() == 0
    # the row hash covers the data columns only (registry order, rescued column last)
    data_cols = [c for c in b.columns if not c.startswith("_")] + ["_rescued_data"]
    again = b.withColumn("h2", row_hash(data_cols))
    assert again.filter(F.col("h2") != F.col("_row_hash")).count() == 0


def test_json_partitions_and_rescue(spark, tmp):
    landing, system, bronze = f"{tmp}/landing", f"{tmp}/system", f"{tmp}/bronze"
    write(f"{landing}/bcb/codigo=1/2024-01-01_2024-01-31.json", "\n".join([
        json.dumps({"codigo": 1, "data": "02/01/2024", "valor": "4.85"}),
        json.dumps({"codigo": 1, "data": "31/02/2024", "valor": "4.90"}),
    ]))
    write(f"{landing}/bcb/codigo=433/2024-01-01_2024-01-31.json",
          json.dumps({"codigo": 433, "data": "01/01/2024", "valor": "0.42"}))
    cfg = bcb_source(landing, system, bronze)
    run_bronze(spark, cfg)
    b = read_bronze(spark, bronze + "/bcb")
    assert b.count() == 3
    assert sorted(r["codigo"] for r in b.collect()) == ["1", "1", "433"]
    # fixed-schema mode: an unknown key lands in _rescued_data
    cfg2 = feed(cfg.places.landing, f"{system}/checkpoints/bcb2", f"{bronze}/bcb2", "json",
                        new_columns=False)
    run_bronze(spark, cfg2)
    write(f"{landing}/bcb/codigo=1/2024-02-01_2024-02-29.json",
          json.dumps({"codigo": 1, "data": "01/02/2024", "valor": "4.95", "Nota Extra": "rev"}))
    run_bronze(spark, cfg2)
    b2 = read_bronze(spark, bronze + "/bcb2")
    r = b2.filter(F.col("data") == "01/02/2024").collect()[0]
    assert json.loads(r["_rescued_data"]) == {"nota_extra": "rev"}
    assert "nota_extra" not in b2.columns


def test_weather_json_lines(spark, tmp):
    landing, system, bronze = f"{tmp}/landing", f"{tmp}/system", f"{tmp}/bronze"
    rows = [{"icao": "SBGR", "time": f"2024-01-01T0{h}:00", "temperature_2m": 20.5 + h, "precipitation": 0.1 * h,
             "wind_speed_10m": 10, "cloud_cover": 50, "visibility": None} for h in range(3)]
    write(f"{landing}/open_meteo/icao=SBGR/2024-01-01_2024-01-01.json", "\n".join(json.dumps(r) for r in rows))
    run_bronze(spark, weather_source(landing, system, bronze))
    b = read_bronze(spark, bronze + "/open_meteo")
    assert b.count() == 3
    assert set(b.columns) >= {"icao", "time", "temperature_2m", "precipitation", "_source_file"}


def test_csv_with_bom_and_latin1(spark, tmp):
    landing, system, bronze = f"{tmp}/landing", f"{tmp}/system", f"{tmp}/bronze"
    write(f"{landing}/a/f1.csv", "﻿preamble\nCódigo;Nome\n1;São Paulo\n")
    cfg = feed(f"{landing}/a", f"{system}/a", f"{bronze}/a", "csv", options={"sep": ";"},
                       preamble=1)
    run_bronze(spark, cfg)
    assert [tuple(r) for r in read_bronze(spark, f"{bronze}/a").select("código", "nome").collect()] == [("1", "São Paulo")]
    write(f"{landing}/b/f1.csv", "Código;Nome\n2;Maceió\n", encoding="latin-1")
    cfg = feed(f"{landing}/b", f"{system}/b", f"{bronze}/b", "csv",
                       options={"sep": ";", "encoding": "ISO-8859-1"})
    run_bronze(spark, cfg)
    assert [tuple(r) for r in read_bronze(spark, f"{bronze}/b").select("código", "nome").collect()] == [("2", "Maceió")]


def test_empty_landing_is_a_no_op(spark, tmp):
    cfg = feed(f"{tmp}/landing/none", f"{tmp}/system/none", f"{tmp}/bronze/none", "csv")
    assert run_bronze(spark, cfg) is None


def test_file_landing_during_a_run_is_not_lost(spark, tmp):
    from punctua.sources.ingest import bronze_frame, discover
    landing, system, bronze = f"{tmp}/landing", f"{tmp}/system", f"{tmp}/bronze"
    write(f"{landing}/a/f1.csv", "id;name\n1;x\n")
    cfg = feed(f"{landing}/a", f"{system}/a", f"{bronze}/a", "csv", options={"sep": ";"})
    reg = discover(spark, cfg)
    write(f"{landing}/a/f2.csv", "id;name\n2;y\n")            # lands after discovery
    q = (bronze_frame(spark, cfg, reg).writeStream.format("parquet").option("path", cfg.places.bronze)
         .option("checkpointLocation", cfg.stream_checkpoint).trigger(availableNow=True).start())
    try:
        q.awaitTermination()
        raise AssertionError("expected the micro-batch to fail")
    except Exception as e:  # noqa: BLE001
        assert "landed during the run" in str(e)
    run_bronze(spark, cfg)                                    # next run discovers f2 and ingests both
    assert sorted(r["id"] for r in read_bronze(spark, f"{bronze}/a").collect()) == ["1", "2"]


def test_manifest_compaction_keeps_every_file_once(spark, tmp):
    from punctua.sources.ingest import Registry
    landing, system, bronze = f"{tmp}/landing", f"{tmp}/system", f"{tmp}/bronze"
    cfg = feed(f"{landing}/a", f"{system}/a", f"{bronze}/a", "csv", options={"sep": ";"})
    for i in range(4):                                   # one manifest file per run
        write(f"{landing}/a/f{i}.csv", f"id;name\n{i};n{i}\n")
        run_bronze(spark, cfg)
    reg = Registry.load(spark, cfg)
    assert reg.compact(spark, max_files=2)
    m = reg.manifest(spark)
    assert m.count() == 4 and m.select("hf").distinct().count() == 4
    write(f"{landing}/a/f9.csv", "id;name\n9;n9\n")
    run_bronze(spark, cfg)
    assert sorted(r["id"] for r in read_bronze(spark, f"{bronze}/a").collect()) == ["0", "1", "2", "3", "9"]


def _bronze(spark, tmp, name, texts, **cfg):
    for path, text in texts.items():
        full = f"{tmp}/{name}/in/{path}"
        os.makedirs(os.path.dirname(full), exist_ok=True)
        with open(full, "wb") as f:
            f.write(text if isinstance(text, bytes) else text.encode())
    config = feed(f"{tmp}/{name}/in", f"{tmp}/{name}/system", f"{tmp}/{name}/out", **cfg)
    run_bronze(spark, config)
    return read_bronze(spark, config.places.bronze)


def test_no_line_is_lost_by_value_or_width(spark, tmp):
    many = ",".join(str(i) for i in range(100))
    text = f"note\na,b\n1,2\nnote\na,b\n3,4,{many}\n5,6,,x\n7,\"open\n"
    b = _bronze(spark, tmp, "width", {"my file+1%.csv": text, "second.csv": "note\nb,a\n9,8\n"}, preamble=1)
    rows = {r["a"]: r for r in b.collect()}
    assert {k: r["b"] for k, r in rows.items() if k != "7"} == {"1": "2", "note": None, "a": "b", "3": "4", "5": "6", "8": "9"}
    assert json.loads(rows["3"]["_rescued_data"]) == [f"3,4,{many}"]
    assert json.loads(rows["5"]["_rescued_data"]) == [None, "x"]
    assert json.loads(rows["7"]["_rescued_data"]) == ['7,"open'] and "end" not in rows["7"]["b"]


def test_header_false_encoding_and_skip_rows_option(spark, tmp):
    b = _bronze(spark, tmp, "plain", {"x.csv": "olá\n1;é\n2;ç\n".encode("latin-1")},
                options={"sep": ";", "header": "false", "skipRows": "1", "encoding": "ISO-8859-1"})
    assert sorted((r["_c0"], r["_c1"]) for r in b.collect()) == [("1", "é"), ("2", "ç")]


def test_charset_names_the_header_too(spark, tmp):
    b = _bronze(spark, tmp, "charset", {"x.csv": "código;nome\n1;São\n2;\n3;a;;k;\n4;b;;\n".encode("latin-1")},
                options={"sep": ";", "charset": "ISO-8859-1"})
    rows = {r["código"]: (r["nome"], r["_rescued_data"]) for r in b.collect()}
    assert rows == {"1": ("São", None), "2": (None, None), "3": ("a", '[null,"k",null]'), "4": ("b", None)}


def test_malformed_json_keeps_its_text_and_partitions_are_unescaped(spark, tmp):
    b = _bronze(spark, tmp, "json", {"k=c d/a.json": '{"x": "1"}\nnot json\n', "k=__HIVE_DEFAULT_PARTITION__/b.json": '{"x": "2"}\n'},
                kind="json")
    assert sorted((r["x"] or "", r["_rescued_data"] or "", r["k"] or "") for r in b.collect()) == [
        ("", "not json", "c d"), ("1", "", "c d"), ("2", "", "")]


def test_glob_with_alternatives_and_refused_settings(spark, tmp):
    b = _bronze(spark, tmp, "glob", {"a.csv": "x\n1\n", "b.txt": "x\n2\n", "c.log": "x\n3\n"}, files="*.{csv,txt}")
    assert sorted(r["x"] for r in b.collect()) == ["1", "2"]
    for bad in ({"kind": "xml"}, {"options": {"multiLine": "true"}}, {"options": {"encoding": "UTF-16"}}, {"options": {"charset": "no-such"}}):
        with pytest.raises(ValueError):
            feed("a", "b", "c", **bad)
