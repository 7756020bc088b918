"""JSON sidecars -> one record of model parameters per session."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scalargrid.functions.cells import to_number
from scalargrid.functions.sidecar_json import (
    D_ISO_KEYS,
    D_PAR_KEYS,
    FITTING_METHOD_KEYS,
    first_field,
    has_fields,
    json_fields,
)
from scalargrid.operators.inventory import SESSION_KEYS
from scalargrid.sources.patterns import MODULATED_MARK, NODDI_MARK, TENSOR_MARK


def sidecar_fields(
    sidecars: DataFrame,
    d_par_keys: Sequence[str] = D_PAR_KEYS,
    d_iso_keys: Sequence[str] = D_ISO_KEYS,
    method_keys: Sequence[str] = FITTING_METHOD_KEYS,
) -> DataFrame:
    """Parse ``(subject, session, path, content)`` once per file into typed columns.

    Unreadable JSON counts as a file without fields.
    """
    name = F.substring_index("path", "/", -1)
    parsed = sidecars.withColumn("_fields", json_fields(F.col("content")))
    return parsed.select(
        *SESSION_KEYS,
        "path",
        F.contains(name, F.lit(NODDI_MARK)).alias("is_noddi"),
        F.contains(name, F.lit(TENSOR_MARK)).alias("is_tensor"),
        F.contains(name, F.lit(MODULATED_MARK)).alias("is_modulated"),
        has_fields(F.col("_fields")).alias("readable"),
        first_field(F.col("_fields"), d_par_keys).alias("d_par_text"),
        first_field(F.col("_fields"), d_iso_keys).alias("d_iso_text"),
        first_field(F.col("_fields"), method_keys).alias("method"),
    )


def reduce_sidecars(fields: DataFrame) -> DataFrame:
    """One record per session; "first" is by path.

    The first value found for a parameter counts, even if it is not a number
    (then the parameter is NULL, see :func:`sidecar_problems`).
    """
    noddi, tensor = F.col("is_noddi"), F.col("is_tensor")
    d_par = F.min_by("d_par_text", F.when(noddi & F.col("d_par_text").isNotNull(), F.col("path")))
    d_iso = F.min_by("d_iso_text", F.when(noddi & F.col("d_iso_text").isNotNull(), F.col("path")))
    method = F.min_by("method", F.when(tensor & F.col("readable"), F.col("path")))
    n_noddi, n_tensor = F.count_if(noddi), F.count_if(tensor)
    return (
        fields.groupBy(*SESSION_KEYS)
        .agg(
            d_par.alias("_d_par"),
            d_iso.alias("_d_iso"),
            F.bool_or(noddi & F.col("is_modulated") & F.col("readable")).alias("_modulated"),
            n_noddi.alias("_n_noddi"),
            method.alias("dti_fitting_method"),
            n_tensor.alias("_n_tensor"),
        )
        .where((F.col("_n_noddi") > 0) | (F.col("_n_tensor") > 0))
        .select(
            *SESSION_KEYS,
            to_number(F.col("_d_par")).alias("noddi_d_par"),
            to_number(F.col("_d_iso")).alias("noddi_d_iso"),
            F.when(F.col("_n_noddi") > 0, F.col("_modulated")).alias("noddi_modulated_present"),
            F.nullif("_n_noddi", F.lit(0)).alias("noddi_sidecar_count"),
            "dti_fitting_method",
            F.nullif("_n_tensor", F.lit(0)).alias("dti_sidecar_count"),
        )
    )


def sidecar_problems(fields: DataFrame) -> DataFrame:
    """``(subject, session, path, message)`` of unreadable files and of parameters that are not numbers."""
    text = F.array("d_par_text", "d_iso_text")
    bad = F.filter(text, lambda v: v.isNotNull() & to_number(v).isNull() & (F.lower(v) != "nan"))
    message = F.when(~F.col("readable"), F.concat(F.lit("Could not read "), "path")).when(
        F.col("is_noddi") & (F.size(bad) > 0),
        F.concat(F.lit("could not convert string to float: '"), F.get(bad, F.lit(0)), F.lit("'")),
    )
    return fields.select(
        *SESSION_KEYS, "path", F.concat(F.lit("dwimap_json_error:"), message).alias("message")
    ).where(F.col("message").isNotNull())
