"""Scalar vocabulary: canonical names, shape statistics, names in file names."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Raw column name -> canonical scalar name.
SCALAR_NAMES = {
    "mean_fa": "fa_mean",
    "mean_md": "md_mean",
    "mean_ad": "ad_mean",
    "mean_rd": "rd_mean",
    "mean_icvf": "icvf_mean",
    "mean_isovf": "isovf_mean",
    "mean_od": "od_mean",
    "std_fa": "fa_std",
    "std_md": "md_std",
    "std_icvf": "icvf_std",
    "dti_fa": "fa_mean",
    "dti_md": "md_mean",
    "dti_ad": "ad_mean",
    "dti_rd": "rd_mean",
    "gfa": "gfa_mean",
    "qa": "qa_mean",
    "iso": "iso_mean",
    "rdi": "rdi_mean",
}

# Columns that describe the shape of a bundle.
SHAPE_STATS = (
    "mean_length", "span", "curl", "volume", "endpoint_radius",
    "ncount", "pcount", "step_resolution",
)

# Scalars that a file name may end with.
FILE_SCALARS = ("fa", "md", "ad", "rd", "icvf", "isovf", "od", "ndi", "odi", "fwf")


def canonical_scalar(raw: Column) -> Column:
    """Known name, else ``mean_x -> x_mean`` and ``std_x -> x_std``, else unchanged."""
    name = F.lower(raw)
    known = F.create_map(*[F.lit(v) for v in chain.from_iterable(SCALAR_NAMES.items())])
    return F.coalesce(
        F.element_at(known, name),
        F.regexp_replace(name, r"^(mean|std)_(.*)$", "$2_$1"),
    )


def is_shape_stat(raw: Column) -> Column:
    return raw.isin(*SHAPE_STATS)


def file_stem(file_name: Column) -> Column:
    """File name without its last extension."""
    return F.regexp_replace(file_name, r"(?<=.)\.[^.]*$", "")


def scalar_from_file(file_name: Column) -> Column:
    """``tractometry_MD.csv`` -> ``md``; ``unknown`` when no known scalar ends the name."""
    found = F.regexp_extract(
        F.lower(file_stem(file_name)), f"[_-]({'|'.join(FILE_SCALARS)})$", 1
    )
    return F.when(found != "", found).otherwise(F.lit("unknown"))


def source_from_file(file_name: Column) -> Column:
    """Table type told by the file name; plain bundle means when it tells nothing."""
    name = F.lower(file_name)
    return (
        F.when(F.contains(name, F.lit("bundle_means")), "bundle_means")
        .when(F.contains(name, F.lit("scalarstats")), "scalarstats")
        .otherwise("bundle_means")
    )
