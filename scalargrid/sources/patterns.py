"""File-name vocabulary of the derivative trees."""

from __future__ import annotations

import re
from typing import NamedTuple


class FilePattern(NamedTuple):
    """A kind of file, told by the end of its name and, where given, a regex."""

    category: str       # bundle, sidecar, image_qc, confounds
    source_type: str    # table type, model, or naming era
    priority: int       # lower is preferred within the category
    name_end: str
    name_regex: str | None = None

    @property
    def scan_regex(self) -> str:
        """One regex for the name, to leave out other files while a scan is planned."""
        return self.name_regex or f"{re.escape(self.name_end)}$"


# File-name patterns, by category in order of preference.
BUNDLE_PATTERNS = (
    FilePattern("bundle", "bundle_means", 0, "_bundle_means.tsv"),
    FilePattern("bundle", "scalarstats", 1, "_scalarstats.csv", r"bundles-.*_scalarstats\.csv$"),
    FilePattern(
        "bundle", "tractometry", 2, ".csv", r"(?i)(?:^|_)tractometry(?:[_-][a-z0-9]+)?\.csv$"
    ),
)
SIDECAR_PATTERNS = (
    FilePattern(
        "sidecar", "noddi", 0, "_dwimap.json", r"_model-noddi_param-(icvf|isovf|od)_dwimap\.json$"
    ),
    FilePattern(
        "sidecar", "noddi", 0, "_dwimap.json",
        r"_model-noddi_desc-modulated_param-(icvf|od)_dwimap\.json$",
    ),
    FilePattern(
        "sidecar", "tensor", 1, "_dwimap.json", r"_model-tensor_param-(fa|md|ad|rd)_dwimap\.json$"
    ),
)
QC_PATTERNS = (
    FilePattern("image_qc", "current", 0, "_desc-image_qc.tsv"),
    FilePattern("image_qc", "legacy", 1, "_desc-ImageQC_dwi.csv"),
    FilePattern("confounds", "current", 0, "_desc-confounds_timeseries.tsv"),
    FilePattern("confounds", "legacy", 1, "_confounds.tsv"),
)
DATASET_DESCRIPTION = "dataset_description.json"
GROUP_TABLE = "dwi_group.tsv"
RECON_FOLDER_PREFIX = "qsirecon-"
MODULATED_MARK = "desc-modulated"
NODDI_MARK = "model-noddi"
TENSOR_MARK = "model-tensor"
