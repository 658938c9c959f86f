"""Runs over a folder that grows and is corrected, against whole runs over the same folder."""

import os
import re

import pytest
from pyspark.sql import functions as F

from trapiche.config import DEFAULT_SPEC as SPEC
from trapiche.operators import conform, regression
from trapiche.operators.moments import fit_moments, merge_moments, moments
from trapiche.plans import incremental
from trapiche.plans.etl import run_etl
from trapiche.plans.incremental import output_path, publish_run, published, update_tables
from trapiche.sinks import publish
from trapiche.sinks.publish import AlreadyPublished, Version, expire_versions, manifest
from trapiche.sources.feeds import LINEAGE, read_feeds
from trapiche.sources.ledger import LEDGER_SCHEMA, count_cells, numeric_columns

HEADER = ",".join(("ingenio", "zafra", "semana", *SPEC.summed))


def feed(folder, name, rows, header=HEADER):
    (folder / name).write_text("\n".join([header, *[",".join(map(str, r)) for r in rows]]) + "\n")


def rows_of(season, weeks, mills=4, scale=1.0):
    return [
        (f"Mill {m}", season, w, 110.0 * w * scale, 100.0 * w * scale, 2 * w, (10.0 + m) * w, *range(4))
        for w in weeks
        for m in range(mills)
    ]


@pytest.fixture
def raw(tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    feed(folder, "a.csv", rows_of("2015-2016", [1, 2, 3]))
    feed(folder, "b.csv", rows_of("2016-2017", [1, 2]))
    feed(folder, "c.csv", rows_of("2017-2018", [1]) + rows_of("2010-2011", [1]))
    return folder


def sorted_rows(df, *drop):
    return sorted(map(tuple, df.drop(*drop).select(sorted(set(df.columns) - set(drop))).collect()))


def assert_equals_whole_run(spark, raw, root, tmp_path):
    whole = run_etl(spark, str(raw), str(tmp_path / "whole"))
    for table, expected in (("detail", whole.detail), ("seasons", whole.seasons)):
        mine = published(spark, root, table)
        absent = [c for c in mine.columns if c not in expected.columns]
        assert [tuple(r) for r in mine.select(absent).distinct().collect()] in ([], [(0.0,) * len(absent)])
        for left, right in zip(sorted_rows(mine, *absent), sorted_rows(expected), strict=True):
            assert left == pytest.approx(right)
    model = fit_moments(published(spark, root, "moments")).first()
    fitted = regression.fit(whole.detail).first()
    assert tuple(model) == pytest.approx(tuple(fitted[c] for c in model.asDict()), rel=1e-9)


def test_second_run_reads_what_changed(spark, raw, tmp_path, monkeypatch):
    root = str(tmp_path / "root")
    first = update_tables(spark, str(raw), root)
    assert len(first.read) == 3 and first.seasons == ["2015-2016", "2016-2017", "2017-2018"]
    assert_equals_whole_run(spark, raw, root, tmp_path)
    again = update_tables(spark, str(raw), root)
    assert again.version == first.version and again.read == []
    # A corrected file whose seasons lose a mill, and a new one that goes on with a season.
    feed(raw, "b.csv", rows_of("2016-2017", [1, 2, 3], mills=3, scale=1.5))
    feed(raw, "d.csv", rows_of("2017-2018", [2, 3], scale=2))
    asked = []
    real = incremental.read_feeds

    def spied(*args, headers, **kwargs):
        asked.extend(os.path.basename(p) for p in headers)
        return real(*args, headers=headers, **kwargs)

    monkeypatch.setattr(incremental, "read_feeds", spied)
    second = update_tables(spark, str(raw), root)
    assert sorted(asked) == ["b.csv", "d.csv"] == [os.path.basename(p) for p in second.read]
    assert second.seasons == ["2016-2017", "2017-2018"]
    for table in ("per_file", "detail", "moments"):
        before, after = first.version.parts(table), second.version.parts(table)
        assert before["2015-2016"] == after["2015-2016"]
        assert before["2017-2018"] != after["2017-2018"]
    assert_equals_whole_run(spark, raw, root, tmp_path)
    # A removed file: the runner-up of the other file is the latest again, or the season goes.
    (raw / "d.csv").unlink()
    (raw / "a.csv").unlink()
    third = update_tables(spark, str(raw), root)
    assert [os.path.basename(p) for p in third.gone] == ["a.csv", "d.csv"]
    assert sorted(third.version.parts("detail")) == ["2016-2017", "2017-2018"]
    assert_equals_whole_run(spark, raw, root, tmp_path)


def test_unreadable_and_empty_files(spark, raw, tmp_path):
    root = str(tmp_path / "root")
    feed(raw, "bad.csv", [("X", "2016-2017", 9, *range(8), "more")])
    (raw / "empty.csv").write_text("\n")
    feed(raw, "header.csv", [])
    update_tables(spark, str(raw), root)
    ledger = {os.path.basename(r["path"]): r for r in published(spark, root, "ledger").collect()}
    assert {n for n, r in ledger.items() if not r["readable"]} == {"bad.csv", "empty.csv"}
    assert ledger["header.csv"]["rows"] == 0 and ledger["a.csv"]["rows"] == 12
    assert_equals_whole_run(spark, raw, root, tmp_path)
    assert update_tables(spark, str(raw), root).read == []
    # A file that becomes readable is read.
    feed(raw, "bad.csv", [("X", "2016-2017", 9, *range(8))])
    assert update_tables(spark, str(raw), root).seasons == ["2016-2017"]
    assert_equals_whole_run(spark, raw, root, tmp_path)


def test_nothing_to_read(spark, tmp_path):
    (tmp_path / "none").mkdir()
    assert update_tables(spark, str(tmp_path / "none"), str(tmp_path / "root")).version is None
    assert published(spark, str(tmp_path / "root"), "detail") is None


def test_a_run_that_ends_early_changes_nothing(spark, raw, tmp_path, monkeypatch):
    root = str(tmp_path / "root")
    done = update_tables(spark, str(raw), root)
    before = sorted_rows(published(spark, root, "detail"))
    feed(raw, "b.csv", rows_of("2016-2017", [5], scale=9))
    steps = ("write_parts", "write_whole", "publish")
    for at in range(6):
        count = iter(range(100))

        def ends(real, at=at, count=count):
            def run(*args, **kwargs):
                if next(count) == at:
                    raise RuntimeError("killed")
                return real(*args, **kwargs)

            return run

        with monkeypatch.context() as patched:
            for name in steps:
                patched.setattr(Version, name, ends(getattr(Version, name)))
            with pytest.raises(RuntimeError, match="killed"):
                update_tables(spark, str(raw), root)
        assert manifest(spark, root) == done.version
    assert sorted_rows(published(spark, root, "detail")) == before
    update_tables(spark, str(raw), root)
    assert_equals_whole_run(spark, raw, root, tmp_path)


def test_concurrent_runs_and_expiry(spark, tmp_path):
    root = str(tmp_path / "root")
    df = spark.range(10).withColumn("k", (F.col("id") % 3).cast("string"))
    one, two = Version(spark, root), Version(spark, root)
    parts = one.write_parts(df, "t", "k")
    assert sorted(parts) == ["0", "1", "2"]
    one.publish({"t": parts})
    with pytest.raises(AlreadyPublished):
        two.publish({"t": two.write_parts(df, "t", "k")})
    for number in range(3):
        version = Version(spark, root)
        more = version.write_parts(df.where("k = '1'").withColumn("id", F.lit(number)), "t", "k")
        version.publish({"t": version.base.parts("t") | more})
    gone = expire_versions(spark, root, keep=2)
    # The first version still holds two parts; the loser and the second one hold none.
    assert len(gone) == 2 and manifest(spark, root).number == 4
    found = publish.read_published(spark, root, "t", df.schema, ["1", "x"])
    assert {r["id"] for r in found.collect()} == {2}
    assert publish.read_published(spark, root, "t", df.schema).count() == 10
    assert publish.read_published(spark, root, "t", df.schema, []).count() == 0


def test_catalog_views(spark, raw, tmp_path):
    root = str(tmp_path / "root")
    spark.sql("CREATE DATABASE IF NOT EXISTS weekly")
    update_tables(spark, str(raw), root, database="weekly")
    assert spark.table("weekly.produccion_detallada").count() == 12
    feed(raw, "d.csv", rows_of("2018-2019", [1], mills=7))
    update_tables(spark, str(raw), root, database="weekly")
    assert spark.table("weekly.produccion_detallada").count() == 19
    assert spark.table("weekly.produccion_anual").count() == 4


def test_publish_run_shows_all_outputs_or_none(spark, raw, tmp_path, monkeypatch):
    root = str(tmp_path / "root")
    first = publish_run(spark, str(raw), root)
    stored = output_path(spark, root, "metrics")
    assert spark.read.json(stored).count() == 1
    feed(raw, "d.csv", rows_of("2018-2019", [1], mills=7))
    for name in ("run_etl", "run_model"):
        real = getattr(incremental, name)

        def half(*args, real=real, **kwargs):
            real(*args, **kwargs)
            raise RuntimeError("killed")

        monkeypatch.setattr(incremental, name, half)
        with pytest.raises(RuntimeError, match="killed"):
            publish_run(spark, str(raw), root)
        monkeypatch.undo()
        assert manifest(spark, root) == first and output_path(spark, root, "metrics") == stored
    publish_run(spark, str(raw), root)
    detail = spark.read.parquet(output_path(spark, root, "detail"))
    assert detail.count() == 19 and output_path(spark, root, "none") is None


def test_types_from_counts(spark, tmp_path):
    header = "ingenio,zafra,half,more,sparse,none,text"
    rows = [
        ("1", "2015-2016", "1" if i % 2 else "x", "1,5" if i < 4 else "7", "" if i else "3", "", f"t{i}")
        for i in range(10)
    ]
    feed(tmp_path, "a.csv", [[f'"{c}"' for c in r] for r in rows], header)
    feed(tmp_path, "b.csv", [("2", "2015-2016", "5")], "ingenio,zafra,more")
    feeds = read_feeds(spark, str(tmp_path))
    columns = ["ingenio", "half", "more", "sparse", "none", "text"]
    counts = count_cells(feeds, columns, "zafra").withColumn("readable", F.lit(True))
    expected = conform.numeric_text_columns(feeds, columns)
    assert numeric_columns(counts, columns) == expected
    assert "sparse" in expected and "half" not in expected
    ledger = spark.createDataFrame([], LEDGER_SCHEMA)
    assert numeric_columns(ledger, ["x"]) == ["x"] and numeric_columns(ledger, []) == []


def assert_close(mine, theirs):
    # Means near 1e9 leave nine digits to what lies about them.
    assert mine.keys() == theirs.keys()
    for name, value in theirs.items():
        assert mine[name] == (value if value is None or isinstance(value, str) else pytest.approx(value, rel=1e-7))


def test_moments_merge(spark):
    rows = [("A" if i % 3 else "B", f"s{i % 4}", 1e9 + i * i % 17, 5e8 + i % 7) for i in range(60)]
    rows += [("A", "s1", None, 1.0), ("C", "s1", 3.0, None), ("D", "s9", 2.0, 4.0)]
    df = spark.createDataFrame(rows, "ingenio string, zafra string, cana_molida_neta double, azucar_producida_total double")
    stored = moments(df, SPEC.keys)
    for selection in ("true", "zafra < 's2'", "ingenio = 'A'", "ingenio = 'D'"):
        mine = fit_moments(stored.where(selection)).first().asDict()
        theirs = regression.fit(df.where(selection)).first().asDict()
        assert_close(mine, theirs)
    grouped = {r["ingenio"]: r for r in fit_moments(stored, ["ingenio"]).collect()}
    for r in regression.fit(df, group_cols=["ingenio"]).where("n > 0").collect():
        assert_close(grouped[r["ingenio"]].asDict(), r.asDict())
    nothing = merge_moments(stored.where("false")).first()
    assert nothing["n"] == 0 and nothing["sxx"] is None
    # Merging in steps gives what merging at once does.
    steps = merge_moments(merge_moments(stored, ["zafra"])).first().asDict()
    assert_close(steps, merge_moments(stored).first().asDict())


def lines(spark, count=3):
    cells = [("M", "2015-2016", str(w), *["1.5"] * len(SPEC.summed), None, "n/d", "f", 0, w) for w in range(count)]
    names = [*SPEC.kept, *LINEAGE]
    kinds = ["string"] * (len(SPEC.kept) + 1) + ["long"] * 2
    return spark.createDataFrame(cells, ", ".join(f"{n} {k}" for n, k in zip(names, kinds)))


def test_measures_are_converted_after_the_latest_row_is_found(spark):
    found = incremental._per_file(lines(spark), SPEC)
    below = found._jdf.queryExecution().optimizedPlan().toString().split("Window [", 1)[1]
    assert below.count("cast(") == below.count("cast(semana")
    assert [r[SPEC.period] for r in found.collect()] == [2.0]
    assert found.first()["rendimiento_fabrica"] == 0.0


def test_cells_are_counted_in_a_plain_hash_aggregate(spark):
    feeds = lines(spark).withColumn(SPEC.season, F.expr("if(semana = '0', null, zafra)"))
    counted = count_cells(feeds, SPEC.kept, SPEC.season)
    plan = counted._jdf.queryExecution().executedPlan().toString()
    # The rows of the feeds meet the lowest aggregate, which has no sets to gather.
    assert re.findall(r"(\w+Aggregate)\(", plan)[-1] == "HashAggregate"
    row = counted.first()
    assert (row["rows"], row["seasons"]) == (3, ["2015-2016"])
    assert row["present"] | {SPEC.net: 3} == row["present"] and row["present"][SPEC.season] == 2
    assert row["parsed"][SPEC.net] == 3 and row["parsed"]["rendimiento_fabrica"] == 0
