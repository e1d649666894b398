"""Catalog-level jobs on the F2 / F3 cases: build from header records,
link to the registry, repair and preview patient ids, test phase."""

import datetime as dt

from cathlake.functions.schema import catalog_types
from cathlake.operators import catalog

REC = "path string, header map<string,string>"


def rec(path, **h):
    return (path, h)


def test_build_catalog_cases(spark):
    rows = [
        rec("/mnt/base/a/1.dcm", PatientID="p1", StudyInstanceUID="s", SeriesInstanceUID="r", SOPInstanceUID="o1",
            StudyDate="20200101", SeriesTime="093015.123", NumberOfFrames="3.0", FrameTime="None",
            Manufacturer="a\rb\\c|d", Modality="XA"),
        rec("/mnt/base/a/0.dcm", PatientID="p1", StudyInstanceUID="s", SeriesInstanceUID="r", SOPInstanceUID="o1",
            StudyDate="20200102", SeriesTime="1"),                     # same 4-part key, smaller path wins
        rec("/mnt/base/b/2.dcm", PatientID="p2", StudyInstanceUID="s", SeriesInstanceUID="r", SOPInstanceUID="o2",
            SeriesTime="9"),                                            # missing date
        rec("/mnt/base/b/3.dcm", PatientID="p2", StudyInstanceUID="s", SeriesInstanceUID="r", SOPInstanceUID="o3",
            StudyDate="20200103"),                                      # missing time
        ("/mnt/base/c/4.dcm", None),                                    # unreadable
        rec("/elsewhere/5.dcm", PatientID="p9", StudyInstanceUID="s", SeriesInstanceUID="r", SOPInstanceUID="o9"),
    ]
    recs = spark.createDataFrame(rows, REC)
    built, rejects = catalog.build_catalog(recs, base_folder="base")
    assert built.columns == list(catalog_types())
    got = {r.DcmPathFlatten: r for r in built.collect()}
    assert sorted(got) == ["base/a/0.dcm", "base/b/2.dcm", "base/b/3.dcm"]
    assert sorted(r.rowid for r in got.values()) == [0, 1, 2]
    a0 = got["base/a/0.dcm"]
    assert a0.TimeStamp == dt.datetime(2020, 1, 2, 0, 0, 1) and a0.SeriesTime == "100000"
    b2 = got["base/b/2.dcm"]
    assert b2.TimeStamp is None and b2.DateStamp == "0" and b2.SeriesTime == "900000"
    b3 = got["base/b/3.dcm"]
    assert b3.TimeStamp == dt.datetime(2020, 1, 3) and b3.SeriesTime == "000000"
    assert sorted(r.path for r in rejects.collect()) == ["/elsewhere/5.dcm", "/mnt/base/c/4.dcm"]
    # the duplicate-key loser would have had these values
    full = catalog.build_catalog(recs.where("path != '/mnt/base/a/0.dcm'"), base_folder="base")[0]
    a1 = [r for r in full.collect() if r.DcmPathFlatten == "base/a/1.dcm"][0]
    assert a1.NumberOfFrames == 3 and a1.FrameTime is None and a1.Manufacturer == "arbc|d"
    assert a1.SeriesTime == "093015" and a1.TimeStamp == dt.datetime(2020, 1, 1, 9, 30, 15)


def test_link_repair_preview_phase(spark):
    cat = spark.createDataFrame([
        ("p1", "/x/P100/DICOM/1.dcm", dt.datetime(2021, 1, 1, 10), "c1"),
        ("p2", "/x/2.dcm", dt.datetime(2021, 1, 1, 10), None),
    ], "PatientID string, DcmPathFlatten string, TimeStamp timestamp_ntz, kommentar string")
    reg = spark.createDataFrame([(7, "p1", dt.datetime(2021, 1, 1, 14), "k")],
                                "rowid long, bth_pid string, timestamp timestamp_ntz, kommentar string")
    linked = catalog.link_procedures(cat, reg)
    assert linked.columns == ["PatientID", "DcmPathFlatten", "TimeStamp", "kommentar",
                              "bth_pid", "pats_timestamp", "pats_kommentar"]
    got = {r.PatientID: r.pats_kommentar for r in linked.collect()}
    assert got == {"p1": "k", "p2": None}
    fixed = {r.DcmPathFlatten: r.PatientID for r in catalog.repair_patient_id(cat).collect()}
    assert fixed == {"/x/P100/DICOM/1.dcm": "P100", "/x/2.dcm": "p2"}
    prev = catalog.preview_patient_repair(cat).collect()
    assert [(r.old_id, r.new_id) for r in prev] == [("p1", "P100")]
    ids = spark.createDataFrame([("p2",)], "PatientID string")
    ph = {r.PatientID: r.phase for r in catalog.assign_test_phase(cat, ids).collect()}
    assert ph == {"p1": None, "p2": "test"}


def test_inventory_stages(spark):
    import os
    import tempfile
    root = tempfile.mkdtemp(prefix="cathlake-inv-")
    tree = os.path.join(root, "tree", "a")
    os.makedirs(tree)
    open(os.path.join(tree, "1.dcm"), "wb").write(b"\0" * 128 + b"DICM" + b"x")
    open(os.path.join(tree, "2.txt"), "w").write("no")
    stages = os.path.join(root, "stages")
    valid, fun = catalog.inventory_stages(spark, os.path.join(root, "tree"), stage_dir=stages)
    assert [os.path.basename(r.path) for r in valid.collect()] == ["1.dcm"]
    f = fun.collect()[0]
    assert (f.n_candidates, f.n_valid) == (2, 1)
    # a rerun reads the stored stages (a new file is not picked up)
    open(os.path.join(tree, "3.dcm"), "wb").write(b"\0" * 128 + b"DICM")
    again, _ = catalog.inventory_stages(spark, os.path.join(root, "tree"), stage_dir=stages)
    assert again.count() == 1


def test_end_to_end_flow(spark):
    """The README chain on local fixtures: inventory -> build -> upsert ->
    registry -> link -> annotations -> diagnostic flag -> report."""
    import json
    import os
    import tempfile

    from cathlake import (build_catalog, cohort_report, flag_diagnostic, inventory_stages,
                          link_procedures, merge_annotations, registry_wide, upsert_catalog)
    from cathlake.operators.numbering import dense_ids
    from cathlake.sources import headers, readers, sinks

    root = tempfile.mkdtemp(prefix="cathlake-e2e-")
    img = os.path.join(root, "images", "p1")
    os.makedirs(img)
    for i in range(3):
        open(os.path.join(img, f"{i}.dcm"), "wb").write(b"\0" * 128 + b"DICM")
    valid, funnel = inventory_stages(spark, os.path.join(root, "images"))
    paths = sorted(r.path for r in valid.collect())
    assert funnel.collect()[0].n_valid == 3
    hdr = [{"PatientID": "p1", "StudyInstanceUID": "s1", "SeriesInstanceUID": "r1",
            "SOPInstanceUID": f"o{i}", "StudyDate": "20210101", "SeriesTime": f"10{i}000",
            "Modality": "XA", "labels_predictions": str(lab)}
           for i, lab in enumerate([1, 1, 0])]
    recs = spark.createDataFrame([(p, json.dumps(h)) for p, h in zip(paths, hdr)], "path string, raw string")
    catalog, rejects = build_catalog(headers.parse_json_records(recs, "raw"), base_folder="images")
    assert catalog.count() == 3 and rejects.count() == 0
    catalog = upsert_catalog(catalog.limit(0), catalog)
    assert sorted(r.rowid for r in catalog.collect()) == [0, 1, 2]

    reg_path = os.path.join(root, "registry")
    reg_rows = spark.createDataFrame(
        [("p1", "e1", "2021-01-01 12:00:00", "1", "5 LM", "70", "0.8", "A", "x")],
        "bth_pid string, entryid string, procedurestart_lokalbed_velse string, sub_entryid string, "
        "proceduresite string, stenosegrad_eyeball string, ffr string, kartype string, other string")
    sinks.write_csv(reg_rows, reg_path, sep="\t")
    registry = dense_ids(registry_wide(readers.read_tsv(spark, reg_path)),
                         ["bth_pid", "entryid", "timestamp"], "rowid")
    linked = link_procedures(catalog, registry).collect()
    assert all(r["Sten %: 5 LM"] == 70.0 for r in linked)

    ann_path = os.path.join(root, "ann")
    ann = spark.createDataFrame([("p1", "r1", "s1", "o0", "2")], "PatientID string, SeriesInstanceUID string, "
                                "StudyInstanceUID string, SOPInstanceUID string, labels string")
    sinks.write_csv(ann, ann_path)
    merged = merge_annotations(catalog, readers.read_strings(spark, ann_path))
    assert sorted((r.SOPInstanceUID, r.labels) for r in merged.collect()) == [("o0", 2), ("o1", None), ("o2", None)]
    assert dict(merged.dtypes)["labels"] == "bigint"

    flagged = {r.SOPInstanceUID: r.diagnostic_data for r in flag_diagnostic(catalog).collect()}
    assert flagged == {"o0": True, "o1": True, "o2": True}  # a 1-run (o0, o1) and a 0-run (o2)
    rep = cohort_report(catalog).collect()[0]
    assert (rep.n_rows, rep.n_xa, rep.n_patients, rep.n_studies) == (3, 3, 1, 1)
