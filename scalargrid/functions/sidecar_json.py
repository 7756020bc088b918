"""JSON text: one parse per document, then lookups by key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Keys that hold a parameter, tried in this order.
D_PAR_KEYS = ("d_par", "dpar", "IntrinsicDiffusivity", "intrinsic_diffusivity", "dPar")
D_ISO_KEYS = ("d_iso", "diso", "IsotropicDiffusivity", "isotropic_diffusivity", "dIso")
FITTING_METHOD_KEYS = ("FittingMethod", "fitting_method", "Method", "method")

UNKNOWN_VERSION = "unknown"


def json_fields(content: Column) -> Column:
    """Top-level keys as MAP<STRING, STRING>; NULL for anything but a JSON object in UTF-8."""
    return F.when(F.is_valid_utf8(content), F.from_json(content, "map<string,string>"))


def has_fields(fields: Column) -> Column:
    """True for a readable, non-empty object."""
    return F.coalesce(F.size(fields) > 0, F.lit(False))


def first_field(fields: Column, keys: Sequence[str]) -> Column:
    """Value of the first key that is present and not null."""
    return F.coalesce(*[F.element_at(fields, k) for k in keys])


def dataset_version(content: Column) -> Column:
    """Version of the first generator, else the top-level one, else ``unknown``."""
    generator = F.get_json_object(content, "$.GeneratedBy[0].Version")
    return F.coalesce(
        F.nullif(generator, F.lit("")),
        F.get_json_object(content, "$.Version"),
        F.lit(UNKNOWN_VERSION),
    )
