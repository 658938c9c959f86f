import pytest

from trapiche.operators.conform import keep_columns
from trapiche.operators.snapshot import latest_snapshot
from trapiche.sources.feeds import (
    LINEAGE,
    UNREADABLE,
    drop_unreadable_files,
    merge_aliases,
    normalize_columns,
    read_feeds,
    read_headers,
)


def write(folder, name, text, encoding="utf-8"):
    (folder / name).write_bytes(text.encode(encoding))


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_headers_differ_in_order_case_spaces_and_names(spark, tmp_path):
    write(tmp_path, "a_2015_2016.csv", "ingenio,zafra,semana,cana_molida_neta\nA,2015-2016,1,10\n")
    write(
        tmp_path,
        "b_2016_2017.csv",
        " Cania Molida Neta ,ZAFRA,No_S_Zafra,Ingenio\n20,2016-2017,3,B\n",
    )
    df = read_feeds(spark, str(tmp_path))
    assert rows(df, "ingenio", "zafra", "semana", "cana_molida_neta", "_src_season") == [
        ("A", "2015-2016", "1", "10", "2015-2016"),
        ("B", "2016-2017", "3", "20", "2016-2017"),
    ]


def test_alias_fills_gaps_of_the_canonical_column(spark, tmp_path):
    write(tmp_path, "a.csv", "zafra,azucar_total,azucar_producida_total\nx,1,\ny,2,5\nz,3,NA\n")
    df = read_feeds(spark, str(tmp_path))
    assert rows(df, "zafra", "azucar_producida_total") == [("x", "1"), ("y", "5"), ("z", "3")]
    assert "azucar_total" not in df.columns


def test_missing_columns_become_null(spark, tmp_path):
    write(tmp_path, "a.csv", "zafra,semana\nx,1\n")
    write(tmp_path, "b.csv", "zafra,superficie_cosechada\ny,7\n")
    df = read_feeds(spark, str(tmp_path))
    assert set(rows(df, "zafra", "semana", "superficie_cosechada")) == {
        ("x", "1", None),
        ("y", None, "7"),
    }


@pytest.mark.parametrize(
    "text, expected", [("Zafra,zafra\nfirst,second\n", "first"), ("zafra,zafra\nfirst,second\n", "first")]
)
def test_clashing_headers_keep_the_first(spark, tmp_path, text, expected):
    write(tmp_path, "a.csv", text)
    df = read_feeds(spark, str(tmp_path))
    assert df.columns.count("zafra") == 1
    assert rows(df, "zafra") == [(expected,)]


def test_one_scan_per_distinct_header(spark, tmp_path):
    for i in range(6):
        write(tmp_path, f"{i}.csv", ("zafra,semana" if i % 2 else "Semana,Zafra") + f"\n{i},{i}\n")
    df = read_feeds(spark, str(tmp_path))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 2
    assert df.count() == 6


def test_missing_tokens_and_quotes(spark, tmp_path):
    write(tmp_path, "a.csv", 'zafra,ingenio\na,"Say ""hi"", mill"\nb,N/A\nc,nan\nd,-\ne, NA\n')
    assert rows(read_feeds(spark, str(tmp_path)), "zafra", "ingenio") == [
        ("a", 'Say "hi", mill'),
        ("b", None),
        ("c", None),
        ("d", "-"),
        ("e", " NA"),
    ]


def test_lineage_follows_input_order(spark, tmp_path):
    write(tmp_path, "b.csv", "zafra\n3\n4\n")
    write(tmp_path, "a.csv", "zafra\n1\n2\n")
    ordered = read_feeds(spark, str(tmp_path)).orderBy(*LINEAGE).select("zafra").collect()
    assert [r[0] for r in ordered] == ["1", "2", "3", "4"]


def test_unreadable_files_are_skipped_whole(spark, tmp_path, caplog):
    write(tmp_path, "empty.csv", "")
    write(tmp_path, "good.csv", "ingenio,zafra\nA,1\nB\n")
    write(tmp_path, "latin.csv", "ingenio,zafra\nCaña,1\nX,2\n", "latin-1")
    write(tmp_path, "ragged.csv", "ingenio,zafra\nC,1\nD,2,extra\n")
    df = read_feeds(spark, str(tmp_path))
    assert UNREADABLE in df.columns
    kept = drop_unreadable_files(df)
    assert set(rows(kept, "ingenio", "zafra")) == {("A", "1"), ("B", None)}
    for name in ("empty.csv", "latin.csv", "ragged.csv"):
        assert name in caplog.text


def test_equal_names_in_two_folders_are_different_files(spark, tmp_path):
    for folder, text in (("x", "ingenio,zafra\nA,1\n"), ("y", "ingenio,zafra\nB,2,extra\n")):
        (tmp_path / folder).mkdir()
        write(tmp_path / folder, "feed.csv", text)
    kept = drop_unreadable_files(read_feeds(spark, f"{tmp_path}/*"))
    assert rows(kept, "ingenio", "zafra") == [("A", "1")]


def test_ties_between_equal_names_have_a_fixed_winner(spark, tmp_path):
    for folder in ("y", "x"):
        (tmp_path / folder).mkdir()
        write(tmp_path / folder, "feed.csv", f"ingenio,zafra,semana,cana_molida_neta\nA,1,5,{folder}\n")
    feeds = read_feeds(spark, f"{tmp_path}/*")
    for partitions in (1, 3):
        snap = latest_snapshot(feeds.repartition(partitions), input_order=LINEAGE)
        assert rows(snap, "cana_molida_neta") == [("x",)]


def test_a_replacement_character_in_valid_text_stays(spark, tmp_path):
    write(tmp_path, "valid one.csv", "ingenio,zafra\nA\ufffdB,1\n")
    write(tmp_path, "latin[1].csv", "ingenio,zafra\nCaña,1\n", "latin-1")
    kept = drop_unreadable_files(read_feeds(spark, str(tmp_path)))
    assert rows(kept, "ingenio", "zafra") == [("A\ufffdB", "1")]


def test_names_that_look_like_patterns(spark, tmp_path):
    for name in ("feed[1].csv", "feed1.csv", "a*b.csv", "{x,y}.csv"):
        write(tmp_path, name, f"ingenio\n{name}\n")
    write(tmp_path, ".hidden.csv", "ingenio\nno\n")
    found = {r[0] for r in rows(read_feeds(spark, str(tmp_path)), "ingenio")}
    assert found == {"feed[1].csv", "feed1.csv", "a*b.csv", "{x"}


def test_names_that_spark_passes_over_are_an_error(spark, tmp_path):
    write(tmp_path, "a.csv", "zafra\nx\n")
    write(tmp_path, "_late.csv", "zafra\ny\n")
    with pytest.raises(ValueError, match="_late.csv"):
        read_feeds(spark, str(tmp_path))


def test_jobs_of_planning_do_not_grow_with_the_files(spark, tmp_path):
    """Spark lists many paths in one job of its own; headers take none."""
    started = []
    for files in (40, 80):
        folder = tmp_path / str(files)
        folder.mkdir()
        for i in range(files):
            write(folder, f"{i:02d}.csv", f"zafra,semana\n{i},1\n")
        spark.sparkContext.setJobGroup(f"plan {files}", "")
        feeds = read_feeds(spark, str(folder))
        started.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"plan {files}")))
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert feeds.count() == files
    assert started[0] == started[1] <= 1


def test_byte_order_mark(spark, tmp_path):
    write(tmp_path, "a.csv", "zafra,semana\nx,1\n", "utf-8-sig")
    assert rows(read_feeds(spark, str(tmp_path)), "zafra", "semana") == [("x", "1")]


def test_names_with_spaces(spark, tmp_path):
    write(tmp_path, "zafra 2015 2016.csv", "zafra\nx\n")
    assert rows(read_feeds(spark, str(tmp_path)), "zafra") == [("x",)]


def test_no_files_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_feeds(spark, str(tmp_path))


def test_known_headers_skip_the_lookup(spark, tmp_path):
    write(tmp_path, "a.csv", "zafra,semana\nx,1\n")
    path = f"file:{tmp_path}/a.csv"
    headers = read_headers(spark, [path])
    assert headers == {path: ("zafra", "semana")}
    assert rows(read_feeds(spark, str(tmp_path), headers=headers), "zafra", "semana") == [("x", "1")]


def test_line_breaks_in_cells(spark, tmp_path):
    write(tmp_path, "a.csv", 'zafra,ingenio\nx,"two\nlines"\n')
    df = read_feeds(spark, str(tmp_path), multi_line=True)
    assert rows(df, "zafra", "ingenio") == [("x", "two\nlines")]


def test_conformance_of_plain_dataframes(table):
    df = table([("a", "1", None, "9")], "`Zafra ` string, zafra string, semana string, `No S Zafra` string")
    done = merge_aliases(normalize_columns(df), {"no_s_zafra": "semana"})
    assert done.columns == ["zafra", "semana"]
    assert [tuple(r) for r in done.collect()] == [("a", "9")]
    assert keep_columns(done, ["semana", "absent"]).columns == ["semana"]
