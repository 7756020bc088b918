from io import StringIO

import pandas as pd
import pytest

from pyspark.sql import functions as F

from scalargrid.sources.files import list_files, path_exists, read_documents
from scalargrid.sources.tables import EMPTY_FILE, LONG_ROW, line_rows, table_cells, table_rows


def rows_of(spark, path, content, **options):
    docs = spark.createDataFrame([(path, content)], "path string, content string")
    return [
        (r["row"], r["header"], r["values"], r["problem"])
        for r in table_rows(docs, **options).orderBy("row").collect()
    ]


def test_separator_by_extension(spark):
    assert rows_of(spark, "a.tsv", "x,1\ty\n1,2\t3\n") == [(1, ["x,1", "y"], ["1,2", "3"], None)]
    assert rows_of(spark, "a.csv", "x\n1\n") == [(1, ["x"], ["1"], None)]


def test_bom_crlf_blank_lines_and_short_rows(spark):
    got = rows_of(spark, "a.tsv", "﻿Bundle Name\t mean_FA \r\n\r\nAF\t1\r\nCST\r\n")
    assert got == [
        (1, ["bundle_name", "mean_fa"], ["AF", "1"], None),
        (2, ["bundle_name", "mean_fa"], ["CST"], None),
    ]


def test_quotes(spark):
    got = rows_of(spark, "a.csv", 'name,note\n"A, left","say ""hi""\nthere"\n')
    assert got == [(1, ["name", "note"], ["A, left", 'say "hi"\nthere'], None)]


def test_repeated_and_blank_names(spark):
    assert rows_of(spark, "a.csv", "fa,fa,,fa\n1,2,3,4\n")[0][1] == ["fa", "fa.1", "unnamed:_2", "fa.2"]


def test_header_styles(spark):
    assert rows_of(spark, "a.csv", " A B \n1\n", header_style="lower")[0][1] == ["a b"]
    assert rows_of(spark, "a.csv", "A B\n1\n", header_style="raw")[0][1] == ["A B"]
    with pytest.raises(ValueError):
        rows_of(spark, "a.csv", "a\n1\n", header_style="other")


def test_header_only(spark):
    assert rows_of(spark, "a.tsv", "bundle_name\n") == []
    assert rows_of(spark, "a.tsv", "fd\n", keep_empty=True) == [(None, ["fd"], None, None)]


def test_unusable_files_are_data(spark):
    assert rows_of(spark, "a.csv", "") == [(None, None, None, EMPTY_FILE)]
    assert rows_of(spark, "a.csv", "a,b\n1,2\n1,2,3\n") == [(None, None, None, LONG_ROW)]


def test_cells_are_padded(spark):
    docs = spark.createDataFrame([("a.csv", "x,y\n1\n")], "path string, content string")
    got = [(r["column"], r["name"], r["cell"]) for r in table_cells(table_rows(docs)).collect()]
    assert sorted(got) == [(0, "x", "1"), (1, "y", None)]


def test_every_file_has_its_own_header(spark):
    docs = spark.createDataFrame([("a.csv", "x,y\n1,2\n"), ("b.csv", "y,x\n3,4\n")],
                                 "path string, content string")
    got = {(r["path"], r["name"], r["cell"]) for r in table_cells(table_rows(docs)).collect()}
    assert got == {("a.csv", "x", "1"), ("a.csv", "y", "2"), ("b.csv", "y", "3"), ("b.csv", "x", "4")}


def test_files_of_any_size_are_read_alike(spark, tmp_path):
    """Quoted line breaks included, however small the pieces that a scan is cut into."""
    (tmp_path / "big.csv").write_text("name,n\n" + "".join(f'"a\n{i}",{i}\n' for i in range(3000)))
    found = []
    for size in ("1m", "2000b"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            rows = table_rows(read_documents(spark, [str(tmp_path)], r"\.csv$")).orderBy("row").collect()
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        found.append([tuple(r["values"]) for r in rows])
    assert found[0] == found[1] == [(f"a\n{i}", str(i)) for i in range(3000)]


def test_quotes_count_at_the_start_of_a_cell_only(spark):
    text = 'A 5" x,1\nB,2\n"C,""c""\nd",3\n"E"e,4\n\ue000\ue003,"5,\ue001"\n,6\n"open,7\n'
    got = [v for _, _, v, _ in rows_of(spark, "a.csv", "k,v\n" + text)]
    assert got == [["A 5\" x", "1"], ["B", "2"], ['C,"c"\nd', "3"], ["Ee", "4"], ["\ue000\ue003", "5,\ue001"], ["", "6"], ['"open', "7"]]


def test_cells_are_those_of_pandas(spark):
    for text in ('a,b\n1,"x,y"\n"2",z\n', 'a,b\n"p""q",\n,"r\ns"\n', 'a,b\n x "y" ,1\n5" pipe,2\n'):
        want = pd.read_csv(StringIO(text), dtype=str, keep_default_na=False)
        assert [v for _, _, v, _ in rows_of(spark, "a.csv", text)] == want.to_numpy().tolist()


def test_lines_of_a_table(spark):
    lines = spark.createDataFrame(
        [("a.csv", 0, "x,y"), ("a.csv", 2, '"3,3",4'), ("a.csv", 1, "1,2"), ("b.csv", 0, "x"), ("b.csv", 1, "1,2")],
        "path string, row long, line string")
    got = sorted((r["path"], r["row"], r["values"], r["problem"]) for r in line_rows(lines).collect())
    assert got == [("a.csv", 1, ["1", "2"], None), ("a.csv", 2, ["3,3", "4"], None), ("b.csv", 0, None, LONG_ROW)]


def test_no_task_owns_the_lines_of_a_path(spark):
    """Lines of a path with most of them meet their header where they are, and sums by path combine before the shuffle."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = spark.range(1000).selectExpr("concat('hot', id % 1, '.csv') as path", "id as row", "if(id = 0, 'x,y', '1,2') as line")
        rows = line_rows(lines)
        assert rows.count() == 999
        tasks = [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]
        plan = rows.groupBy("path").count()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    above, below = plan.split("BroadcastHashJoin", 1)
    assert "partial_count" in above and "Exchange" in above, plan
    assert max(tasks) <= 2 * min(tasks) and len(tasks) >= 4, tasks


def test_listing(spark, tmp_path):
    (tmp_path / "a b").mkdir()
    (tmp_path / "a b" / "x+1.csv").write_text("1")
    (tmp_path / "a b" / "y.tsv").write_text("12")
    got = {(r["path"].split("/")[-2:][0], r["path"].split("/")[-1], r["file_size"])
           for r in list_files(spark, [str(tmp_path)]).collect()}
    assert got == {("a b", "x+1.csv", 1), ("a b", "y.tsv", 2)}
    named = list_files(spark, [str(tmp_path)], r"\.tsv$")
    # One part for the one file that the scan is left with, one for files without a byte, which scans leave out.
    assert named.count() == 1 and named.rdd.getNumPartitions() == 2
    assert list_files(spark, [str(tmp_path / "none-*")]).count() == 0
    assert path_exists(spark, str(tmp_path)) and not path_exists(spark, str(tmp_path / "none"))
    plan = list_files(spark, [str(tmp_path)])._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan
