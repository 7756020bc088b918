"""Data dictionary: one row per column of the primary table, from its schema."""

from __future__ import annotations

from pyspark.sql import DataFrame

DICTIONARY_COLUMNS = (
    "column_name", "description", "units", "model", "source_file_pattern", "notes",
)

_IMAGE_QC = "*_desc-image_qc.tsv"
_CONFOUNDS = "*_desc-confounds_timeseries.tsv"
_ICVF = "*_model-noddi_param-icvf_dwimap.json"

# Known columns: description, units, model, source file pattern, notes.
# Names, units, models and file patterns.
KNOWN_COLUMNS = {
    "subject": ("Label of the subject folder", "", "", "BIDS directory structure", ""),
    "session": (
        "Label of the session folder", "", "", "BIDS directory structure",
        "_no_session where the subject has no session folders",
    ),
    "session_age_months": (
        "Age at the session", "months", "", "sub-<label>_sessions.tsv",
        "NULL without a sessions table or an age column in it",
    ),
    "bundle": (
        "White-matter bundle, in lower case with underscores", "", "", "",
        "The set of bundles depends on the workflow, e.g. 72 for TractSeg",
    ),
    "scalar": (
        "Name of the scalar", "", "", "",
        "Canonical names: fa_mean, md_mean, ad_mean, rd_mean, icvf_mean, isovf_mean, od_mean",
    ),
    "value": (
        "Value of the scalar in this subject, session and bundle",
        "varies (FA: unitless 0-1; MD/AD/RD: mm²/s; ICVF/ISOVF/OD: unitless 0-1)", "", "",
        "NULL where there is no value, see scalar_present",
    ),
    "scalar_present": (
        "Whether any file gave this scalar", "boolean", "", "", "False marks a gap of the grid",
    ),
    "recon_suffix": (
        "Reconstruction workflow the scalar comes from", "", "",
        "qsirecon/derivatives/qsirecon-<suffix>/", "",
    ),
    "bundle_source": (
        "Kind of file the scalar comes from", "", "", "",
        "bundle_means, scalarstats, tractometry or a registered format",
    ),
    "noddi_d_par": (
        "Intrinsic parallel diffusivity assumed by the model fit", "µm²/ms", "noddi", _ICVF,
        "1.7 is the adult default and is biased in infants",
    ),
    "noddi_d_par_flag": (
        "Audit of the assumed diffusivity", "", "noddi", _ICVF,
        "Values: OK:custom_d_par_matches_expected, INFO:adult_default_d_par, "
        "WARN:adult_default_d_par_in_infant, WARN:unexpected_d_par:<value>, "
        "UNKNOWN:sidecar_missing, UNKNOWN:no_noddi_data",
    ),
    "noddi_d_iso": (
        "Isotropic diffusivity assumed by the model fit", "µm²/ms", "noddi",
        "*_model-noddi_param-isovf_dwimap.json", "Usually 3.0",
    ),
    "noddi_modulated_present": (
        "Whether tissue-fraction modulated maps exist", "boolean", "noddi",
        "*_model-noddi_desc-modulated_param-icvf_dwimap.json", "Preferable in infants",
    ),
    "noddi_sidecar_count": (
        "Number of sidecars of the model", "count", "noddi", "*_model-noddi_*_dwimap.json", "",
    ),
    "dti_fitting_method": (
        "How the tensor was fitted", "", "tensor", "*_model-tensor_param-fa_dwimap.json", "",
    ),
    "qc_mean_fd": ("Mean framewise displacement", "mm", "", _IMAGE_QC, ""),
    "qc_max_fd": ("Largest framewise displacement", "mm", "", _IMAGE_QC, ""),
    "qc_ndc": (
        "Neighbouring-volume correlation after preprocessing",
        "unitless (0-1; higher is better)", "", _IMAGE_QC,
        "From t1_neighbor_corr, or neighbor_corr in legacy files",
    ),
    "qc_ndc_raw": (
        "Neighbouring-volume correlation before preprocessing", "unitless (0-1)", "", _IMAGE_QC, "",
    ),
    "qc_num_bad_slices": ("Bad slices after preprocessing", "count", "", _IMAGE_QC, ""),
    "qc_num_bad_slices_raw": ("Bad slices before preprocessing", "count", "", _IMAGE_QC, ""),
    "qc_max_translation": ("Largest absolute translation", "mm", "", _IMAGE_QC, ""),
    "qc_max_rotation": ("Largest absolute rotation", "radians", "", _IMAGE_QC, ""),
    "qc_t1_dice_distance": (
        "Distance of anatomical and diffusion brain masks; lower is better", "unitless (0-1)", "",
        _IMAGE_QC, "",
    ),
    "qc_n_volumes": ("Number of volumes", "count", "", _CONFOUNDS, ""),
    "qc_n_censored": (
        "Volumes whose displacement is above the threshold", "count", "", _CONFOUNDS,
        "The threshold is in qc_fd_threshold_used",
    ),
    "qc_pct_censored": (
        "Share of censored volumes", "proportion (0-1)", "", _CONFOUNDS,
        "qc_n_censored / qc_n_volumes, six digits",
    ),
    "qc_fd_threshold_used": ("Displacement threshold", "mm", "", "", "Parameter fd_threshold"),
    "qsiprep_version": (
        "Version of the preprocessing software", "", "", "qsiprep/dataset_description.json", "",
    ),
    "qsirecon_version": (
        "Version of the reconstruction software", "", "",
        "qsirecon/derivatives/qsirecon-*/dataset_description.json", "",
    ),
    "scalar_raw": (
        "Column name in the source file", "", "", "", "For tracing; analyse by scalar",
    ),
    "is_shape_stat": (
        "Whether the scalar describes the shape of the bundle", "boolean", "",
        "*_scalarstats.csv", "mean_length, volume, span, curl, endpoint_radius and the like",
    ),
}

# Prefix -> description of what follows it, source file pattern.
PREFIX_ENTRIES = {
    "mriqc_": ("MRIQC IQM: ", "mriqc/dwi_group.tsv"),
    "qc_": ("QSIPrep QC metric: ", f"{_IMAGE_QC} or {_CONFOUNDS}"),
    "noddi_": ("NODDI model parameter: ", "*_model-noddi_*_dwimap.json"),
    "dti_": ("DTI model parameter: ", "*_model-tensor_*_dwimap.json"),
}
OTHER_ENTRY = "Auto-documented column: "
GENERATED_NOTE = "Auto-generated entry. dtype="


def _entry(name: str, kind: str) -> tuple[str, ...]:
    if name in KNOWN_COLUMNS:
        return (name, *KNOWN_COLUMNS[name])
    described, source = OTHER_ENTRY + name, ""
    for prefix, (lead, pattern) in PREFIX_ENTRIES.items():
        if name.startswith(prefix):
            described, source = lead + name.removeprefix(prefix), pattern
            break
    return (name, described, "", "", source, GENERATED_NOTE + kind)


def data_dictionary(table: DataFrame) -> DataFrame:
    """One row per column; only the schema is used, no data is read."""
    rows = [_entry(f.name, f.dataType.simpleString()) for f in table.schema.fields]
    schema = ", ".join(f"{c} string" for c in DICTIONARY_COLUMNS)
    return table.sparkSession.createDataFrame(rows, schema)
