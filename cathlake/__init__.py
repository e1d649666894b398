"""cathlake: Spark-native jobs for imaging-series catalogs and the procedure
records that go with them (inventory, normalisation, de-duplication, upserts,
registry pivots, interval linkage, annotation merges, leading-run flags and
cohort reports), written as plain DataFrame / SQL plans."""

from cathlake.session import checkpoint_dir, get_session  # noqa: F401
from cathlake.operators.catalog import (build_catalog, inventory_stages,  # noqa: F401
                                        link_procedures, repair_patient_id)
from cathlake.operators.cohort import cohort_report, exclusion_report  # noqa: F401
from cathlake.operators.episodes import flag_diagnostic, leading_runs_v1  # noqa: F401
from cathlake.operators.labels import assign_phase, merge_annotations, synthetic_labels  # noqa: F401
from cathlake.operators.registry import cardinality_profile, registry_wide  # noqa: F401
from cathlake.operators.upsert import upsert_catalog  # noqa: F401

__all__ = ["get_session", "checkpoint_dir", "inventory_stages", "build_catalog", "upsert_catalog",
           "registry_wide", "cardinality_profile", "link_procedures", "merge_annotations",
           "flag_diagnostic", "leading_runs_v1", "cohort_report", "exclusion_report",
           "repair_patient_id", "assign_phase", "synthetic_labels"]
