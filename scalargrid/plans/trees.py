"""File trees written by Spark from the benchmark tables, to be listed, read and collated like any other.

A supplier is the subject and a year the session, as in ``inputs``. Of the bundle tables, every tenth
session has a file without a byte and every tenth one that is no UTF-8 text.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scalargrid.plans import inputs
from scalargrid.runtime import shared_dir
from scalargrid.sources.patterns import GROUP_TABLE


def write_files(files: DataFrame, folder: str) -> int:
    """Write ``(path, data)`` as files below a folder that executors share; returns their number.

    A task that runs again writes the same bytes to the same places.
    """

    def written(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        system, top = fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")
        for batch in batches:
            for path, data in zip(batch["path"], batch["data"], strict=True):
                place = f"{top.rstrip('/')}/{path.lstrip('/')}"
                system.create_dir(place.rpartition("/")[0], recursive=True)
                with system.open_output_stream(place) as out:
                    out.write(bytes(data))
            yield pd.DataFrame({"n": [len(batch)]})

    return files.select("path", "data").mapInPandas(written, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def tree_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(path, data)`` of all files of a study: bundle tables, motion, ages, model sidecars, descriptions."""
    bundles = inputs.bundle_documents(spark, sf_dir).select(
        F.regexp_replace("path", "^/data/", "").alias("path"),
        F.expr("""case (s + y) % 10 when 0 then binary('') when 1 then concat(unhex('FFFE'), binary(content))
                  else binary(content) end""").alias("data"),
    )
    sessions = inputs.table(spark, sf_dir, "lineitem").selectExpr(
        "l_suppkey as s", "year(l_shipdate) as y", "l_orderkey * 8 + l_linenumber as i", "round(l_tax * 10, 2) as fd"
    )
    motion = sessions.groupBy("s", "y").agg(
        F.array_sort(F.collect_list(F.struct("i", F.expr("if(i % 11 = 0, 'n/a', string(fd))").alias("text")))).alias("rows")
    ).selectExpr(
        "concat('preproc/sub-', s, '/ses-', y, '/dwi/x', if(y % 2 = 0, '_desc-confounds_timeseries.tsv', '_confounds.tsv')) as path",
        r"binary(if(s % 10 = 3, '', concat('framewise_displacement\tx\n', array_join(transform(rows, r -> concat(r.text, '\t1')), '\n')))) as data",
    )
    ages = sessions.select("s", "y").distinct().groupBy("s").agg(F.array_sort(F.collect_list("y")).alias("years")).selectExpr(
        "concat('preproc/sub-', s, '/sessions.tsv') as path",
        r"binary(concat('session_id\tage\n', array_join(transform(years, y -> concat('ses-', y, '\t', y - 1990)), '\n'))) as data",
    )
    models = sessions.select("s", "y").distinct().where("s % 2 = 0").selectExpr(
        "concat('recon/derivatives/qsirecon-MODEL/sub-', s, '/ses-', y, '/dwi/m_model-noddi_param-od_dwimap.json') as path",
        "case when s % 10 = 4 then binary('') else binary(concat('{\"d_par\": ', if(y % 2 = 0, '1.7', '1.1'), '}')) end as data",
    )
    described = spark.range(1).selectExpr(
        "explode(array('preproc/', 'recon/derivatives/qsirecon-W0/')) as top"
    ).selectExpr("concat(top, 'dataset_description.json') as path", """binary('{"GeneratedBy": [{"Version": "1.2"}]}') as data""")
    return bundles.unionByName(motion).unionByName(ages).unionByName(models).unionByName(described)


def write_tree(spark: SparkSession, sf_dir: str, subjects: bool = True) -> str:
    """A new study folder below the shared one, with a group table of one row per supplier and year.

    Without ``subjects`` it has only that table: a job on it alone opens no other file, and each of these
    takes a block and two or three folders of the disk, however few bytes it has.
    """
    folder = f"{shared_dir(spark).rstrip('/')}/study-{uuid.uuid4().hex}"
    if subjects:
        write_files(tree_files(spark, sf_dir), folder)
    inputs.table(spark, sf_dir, "lineitem").selectExpr("l_suppkey as s", "year(l_shipdate) as y", "l_quantity as q").groupBy("s", "y").agg(
        F.sum("q").cast("long").alias("volume")
    ).selectExpr(
        # As for the files, whose paths have both.
        "coalesce(concat('sub-', s), raise_error('a row without a supplier')) as subject_id",
        "coalesce(concat('ses-', y), raise_error('a row without a year')) as session_id", "volume", "if(s % 2 = 0, 'a', 'b') as site"
    ).write.option("sep", "\t").option("header", True).csv(f"{folder}/group/{GROUP_TABLE}")
    return folder
