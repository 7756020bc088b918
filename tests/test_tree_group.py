"""The group table alone: no other file of the study is written for it."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from compare import compare, connect
from scalargrid.plans import trees


def write_lineitem(spark, tmp_path, supplier="id % 4"):
    spark.range(60).selectExpr(
        "id as l_orderkey", f"{supplier} as l_suppkey", "int(id % 7) as l_linenumber", "double(id % 9) as l_quantity",
        "0.0D as l_discount", "double(id % 8) / 100 as l_tax", "if(id % 2 = 0, 'A', 'N') as l_returnflag",
        "cast(date_add(date'1994-01-01', int(id * 30)) as timestamp_ntz) as l_shipdate",
    ).coalesce(1).write.parquet(str(tmp_path / "part"))
    next((tmp_path / "part").glob("*.parquet")).rename(tmp_path / "lineitem.parquet")


def test_group_table_writes_no_files_of_subjects(spark, tmp_path, monkeypatch):
    write_lineitem(spark, tmp_path)
    written = []
    monkeypatch.setattr(trees, "write_files", lambda files, folder: written.append(folder))
    found = entry.queries()["tree_group_table"](spark, str(tmp_path))
    assert compare(found, connect(str(tmp_path)), entry.oracle_sql()["tree_group_table"]) is None and found.count() > 8
    assert written == []


def test_a_row_without_a_supplier_has_no_place_in_a_study(spark, tmp_path):
    write_lineitem(spark, tmp_path, "nullif(id % 4, 3)")
    with pytest.raises(Exception, match="without a supplier"):
        entry.queries()["tree_group_table"](spark, str(tmp_path))
