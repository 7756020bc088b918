"""Audit flag for an assumed model parameter."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Adult default of the parameter, tolerance, and flag texts.
ADULT_DEFAULT_D_PAR = 1.7
D_PAR_TOLERANCE = 1e-6
INFANT_WARNING = "WARN:adult_default_d_par_in_infant"
ADULT_DEFAULT = "INFO:adult_default_d_par"
MATCHES_EXPECTED = "OK:custom_d_par_matches_expected"
UNEXPECTED_FORMAT = "WARN:unexpected_d_par:%.4f"
SIDECAR_MISSING = "UNKNOWN:sidecar_missing"
NO_MODEL_DATA = "UNKNOWN:no_noddi_data"


def assumption_flag(
    d_par: Column,
    age_months: Column,
    infant_threshold_months: float = 18.0,
    expected_d_par: float = 1.7,
) -> Column:
    """Flag text, first matching rule wins; an unknown age is not an infant's."""
    missing = d_par.isNull() | F.isnan(d_par)
    default = F.abs(d_par - ADULT_DEFAULT_D_PAR) < D_PAR_TOLERANCE
    infant = F.coalesce(
        ~F.isnan(age_months) & (age_months <= infant_threshold_months), F.lit(False)
    )
    expected = F.abs(d_par - expected_d_par) < D_PAR_TOLERANCE
    return (
        F.when(missing, SIDECAR_MISSING)
        .when(default & infant, INFANT_WARNING)
        .when(default, ADULT_DEFAULT)
        .when(expected, MATCHES_EXPECTED)
        .otherwise(F.format_string(UNEXPECTED_FORMAT, d_par))
    )
