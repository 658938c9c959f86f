"""Whole runs on small feeds, against the same steps done by hand."""

import datetime as dt

import pytest

from trapiche.config import DEFAULT_SPEC as SPEC
from trapiche.operators import kpi
from trapiche.plans.etl import run_etl
from trapiche.plans.modelling import monthly_outlook, run_model
from trapiche.sinks import writers
from trapiche.sources import tables

HEADER_A = "Ingenio,Zafra,Semana,cana_molida_bruta,cana_molida_neta,superficie_cosechada,azucar_producida_total,azucar_producida_refinada,azucar_producida_estandar,azucar_producida_blanca_especial,azucar_producida_mascabado,rendimiento_campo"
HEADER_B = "ZAFRA,INGENIO,NO S ZAFRA,azucar_total,CANIA MOLIDA NETA,cania_molida_bruta,Superficie Cosechada,azucar_refinada,azucar_estandar,azucar_blanca_especial,azucar_mascabado,sobra"


def feed_rows(season, mills, weeks):
    """(mill, season, week, gross, net, area, sugar, four grades), cumulative over weeks."""
    rows = []
    for m in range(mills):
        for w in range(1, weeks + 1):
            net = (1000.0 + 37 * m) * w
            sugar = 0.11 * net + m % 5 * w
            rows.append((f"Mill {m}", season, w, net * 1.05, net, net / 60, sugar, sugar / 2, sugar / 4, sugar / 8, 0.0))
    return rows


@pytest.fixture(scope="module")
def feeds(tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    expected = {}
    a = feed_rows("2015-2016", 12, 4) + [("Old", "2010-2011", 1, 1, 1, 1, 1, 1, 1, 1, 1)]
    lines = [HEADER_A] + [",".join(map(str, (*r, "n/d" if r[2] % 2 else 7))) for r in a]
    # A correction of the last week that comes later in the file loses against the first.
    lines.append("Mill 0,2015-2016,4,9,9,9,9,9,9,9,9,9")
    lines.append("Mill 1,2015-2016,x,9,9,9,9,9,9,9,9,9")
    (folder / "feed_2015_2016.csv").write_text("\n".join(lines) + "\n")
    b = feed_rows("2016-2017", 15, 3)
    lines = [HEADER_B] + [
        ",".join(map(str, (r[1], r[0], r[2], r[6], r[4], r[3], r[5], r[7], r[8], r[9], r[10], "z"))) for r in b
    ]
    (folder / "feed_2016_2017.csv").write_text("\n".join(lines) + "\n")
    (folder / "feed_2017_2018.csv").write_text(HEADER_A + "\n" + "Bad,2017-2018,1" + ",1" * 12 + "\n")
    for r in a + b:
        if r[1] >= "2015":
            expected[r[0], r[1]] = r  # weeks ascend, so the last one stays
    return folder, expected


@pytest.fixture(scope="module")
def etl(spark, feeds, tmp_path_factory):
    out = tmp_path_factory.mktemp("out")
    return run_etl(spark, str(feeds[0]), str(out), detail_csv=True), out


def test_detail(etl, feeds):
    detail = etl[0].detail
    got = {(r["ingenio"], r["zafra"]): r for r in detail.collect()}
    assert set(got) == set(feeds[1])
    for key, r in feeds[1].items():
        assert tuple(got[key][m] for m in SPEC.summed) == pytest.approx(r[3:])
        assert got[key][SPEC.industrial_yield] == pytest.approx(r[6] / r[4] * 100)
        assert got[key][SPEC.start_year] == int(r[1][:4])
    assert "semana" not in detail.columns and not [c for c in detail.columns if c.startswith("_src")]


def test_seasons_and_report(etl, feeds, spark):
    result, out = etl
    rows = {r["zafra"]: r for r in result.seasons.collect()}
    sugar = {z: sum(r[6] for (m, s), r in feeds[1].items() if s == z) for z in rows}
    assert sorted(rows) == ["2015-2016", "2016-2017"]
    for z in rows:
        assert rows[z][SPEC.output] == pytest.approx(sugar[z])
    assert rows["2016-2017"][SPEC.growth] == pytest.approx((sugar["2016-2017"] / sugar["2015-2016"] - 1) * 100)
    report = spark.read.json(result.loaded.report).first()
    assert (report["total_registros"], report["total_zafras"], report["total_ingenios"]) == (27, 2, 15)
    assert report["columnas"] == result.detail.columns


def test_sinks_hold_the_same_table(etl, spark):
    result, out = etl
    narrow = ["ingenio", "zafra", *SPEC.summed, SPEC.start_year]
    expected = result.detail.select(narrow)
    _, from_csv = tables.read_processed(
        spark, result.loaded.season_csv, result.loaded.detail_csv, fmt="csv"
    )
    assert result.loaded.tables == (writers.DETAIL_TABLE, writers.SEASON_TABLE)
    for copy in (from_csv, spark.table(writers.DETAIL_TABLE)):
        assert copy.select(narrow).exceptAll(expected).count() == 0
        assert copy.count() == 27
    seasons, detail = tables.read_processed(spark, f"{out}/seasons", f"{out}/detail")
    assert seasons.count() == 2 and detail.count() == 27
    csv_seasons, absent = tables.read_processed(spark, result.loaded.season_csv, f"{out}/nowhere", fmt="csv")
    assert csv_seasons.exceptAll(result.seasons).count() == 0 and absent is None


@pytest.mark.parametrize("error", [None, RuntimeError("a task failed")])
def test_a_failing_catalog_is_tolerated(etl, tmp_path, caplog, monkeypatch, error):
    result, out = etl

    def fails(*args, **kwargs):
        raise error

    if error:
        monkeypatch.setattr(writers, "register_table", fails)
    loaded = writers.write_tables(
        f"{out}/detail", f"{out}/seasons", kpi.profile(result.detail), str(tmp_path), "no_such_db"
    )
    assert loaded.tables is None and "catalog tables not written" in caplog.text
    assert loaded.detail_csv is None
    assert result.detail.sparkSession.read.json(loaded.report).count() == 1


def test_modelling(etl, spark, tmp_path):
    result, _ = etl
    done = run_model(result.seasons, result.detail, str(tmp_path))
    record = tables.read_record(spark, f"{tmp_path}/metrics", tables.METRICS_SCHEMA).first()
    assert (record["n_samples"], record["n_train"], record["n_test"]) == (27, 21, 6)
    assert record["coeficiente_B1"] == pytest.approx(0.11, abs=0.01)
    told = tables.read_record(spark, f"{tmp_path}/interpretation", tables.INTERPRETATION_SCHEMA).first()
    assert told["ecuacion"].startswith("Y = ") and told["pronostico"]["siguiente_cana"] > 0
    model = tables.read_model(spark, f"{tmp_path}/model").first()
    assert model["n"] == 21 and model["b1"] == record["coeficiente_B1"]
    stats = tables.read_model(spark, f"{tmp_path}/inference").first()
    assert stats["n"] == 27
    months = monthly_outlook(result.seasons, done, dt.date(2017, 6, 1))
    assert months.count() == 24
    assert tables.read_record(spark, f"{tmp_path}/none", tables.METRICS_SCHEMA) is None
    assert tables.read_model(spark, f"{tmp_path}/none") is None


def test_modelling_falls_back_to_the_season_table(spark, table, tmp_path):
    from golden import SUMS, SUMS_SCHEMA

    done = run_model(table(SUMS, SUMS_SCHEMA), None, str(tmp_path))
    assert done.model.first()["n"] == 8
    assert done.metrics.first()["n_test"] == 3


ODD_MILLS = ("7", 'San "Luis" A, B', "0012", "Santa, Fe")


@pytest.mark.parametrize("reported", [True, False])
def test_stored_detail_reads_back_by_name_and_type(spark, tmp_path, reported):
    header = HEADER_A if reported else HEADER_A.rpartition(",")[0]
    lines = [header]
    for i, mill in enumerate(ODD_MILLS):
        quoted = '"' + mill.replace('"', '""') + '"'
        tail = ",n/d" if reported and i else ",12.5" if reported else ""
        lines.append(f"{quoted},2015-2016,{i + 1},1,2,1,1,1,1,1,1{tail}")
    (tmp_path / "a.csv").write_text("\n".join(lines) + "\n")
    out = str(tmp_path / "out")
    result = run_etl(spark, str(tmp_path), out, detail_csv=True, work=str(tmp_path / "work"))
    assert not list((tmp_path / "work").glob("*"))
    expected = [(f.name, f.dataType.simpleString()) for f in SPEC.detail_schema.fields]
    for seasons, path, fmt in (
        (f"{out}/seasons", f"{out}/detail", "parquet"),
        (result.loaded.season_csv, result.loaded.detail_csv, "csv"),
    ):
        _, detail = tables.read_processed(spark, seasons, path, fmt=fmt)
        assert detail.dtypes == expected
        rows = {r["ingenio"]: r.asDict() for r in detail.collect()}
        assert set(rows) == set(ODD_MILLS)
        for mill, row in rows.items():
            assert row["anio_inicio"] == 2015 and row["rendimiento_agroindustrial"] == 50.0
            if reported:
                assert row["rendimiento_campo"] == (12.5 if mill == "7" else 0.0)
            else:
                assert row["rendimiento_campo"] is None
            assert row["rendimiento_fabrica"] is None
    assert result.detail.dtypes == [(c, t) for c, t in expected if c in result.detail.columns]


def test_work_folder_needs_a_shared_folder_on_a_cluster(tmp_path):
    from types import SimpleNamespace

    def session(master, conf=None, checkpoint=None):
        return SimpleNamespace(
            conf=SimpleNamespace(get=lambda key, default: conf or default),
            sparkContext=SimpleNamespace(master=master, getCheckpointDir=lambda: checkpoint),
        )

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        writers.work_folder(session("spark://host:7077"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        writers.work_folder(session("local-cluster[2,1,1024]"))
    assert writers.work_folder(session("yarn", conf="hdfs:/shared")).startswith("hdfs:/shared/trapiche-")
    assert writers.work_folder(session("yarn", checkpoint="hdfs:/c")).startswith("hdfs:/c/trapiche-")
    assert writers.work_folder(session("yarn"), str(tmp_path)).startswith(str(tmp_path))
    assert "trapiche-" in writers.work_folder(session("local[4]"))
