"""Path expressions for image files (Column -> Column, NULL-propagating)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cathlake.functions.ordering import to_col


def hierarchical_path(root: str, patient, study, series, sop, ext: str = ".dcm") -> Column:
    """``root/patient/study/series/sop.dcm``; NULL if any part is NULL."""
    parts = [to_col(p).cast("string") for p in (patient, study, series, sop)]
    return F.concat(F.lit(root.rstrip("/")), F.lit("/"), parts[0], F.lit("/"), parts[1],
                    F.lit("/"), parts[2], F.lit("/"), parts[3], F.lit(ext))


def basename(c) -> Column:
    return F.substring_index(to_col(c), "/", -1)


def output_path(folder: str, c) -> Column:
    """``folder/<basename of c>``."""
    return F.concat(F.lit(folder.rstrip("/") + "/"), basename(c))


def flattened_name(index, c) -> Column:
    """Flat copy name: ``<index><basename>``."""
    return F.concat(to_col(index).cast("string"), basename(c))


def relative_to(c, base: str) -> Column:
    """Suffix of the path starting at the first match of the base folder
    name (a regular expression, as in the loader); NULL when it does not
    occur (such rows are rejected by the loader)."""
    col = to_col(c)
    pos = F.regexp_instr(col, F.lit(base))
    return F.when(pos > 0, col.substr(pos, F.length(col)))


def parent_of(c, marker: str = "/DICOM") -> Column:
    """Folder name just above the first ``marker`` segment."""
    return F.substring_index(F.substring_index(to_col(c), marker, 1), "/", -1)


def repair_key(c_key, c_path, marker: str = "/DICOM") -> Column:
    """Key taken from the path where the path contains the marker, else
    unchanged."""
    path = to_col(c_path)
    return F.when(path.contains(marker), parent_of(path, marker)).otherwise(to_col(c_key))
