"""Sources and sinks: missing input, header contract, manifests, seeds,
SQL on files, temp views, catalog, QA snapshots, tracing failures to raw."""

import os

import pytest

import quake_fixtures as qf
from strata.operators.compare import read_snapshot, snapshot
from strata.operators.quality import trace_to_raw
from strata.sources.raw import UnknownSlice, load_raw, read_manifest, read_seed
from strata.sources.tables import (HeaderMismatch, check_header, ensure_database, literal_lookup,
                                   register_views, sql_on_files)


def test_missing_input_raises(spark, workdir):
    with pytest.raises(Exception) as e:
        spark.read.parquet(os.path.join(workdir, "nope")).count()
    assert "PATH_NOT_FOUND" in str(e.value) or "does not exist" in str(e.value)
    with pytest.raises(UnknownSlice):
        read_manifest(spark, os.path.join(workdir, "no_slice"))


def test_header_contract(spark, workdir):
    p = os.path.join(workdir, "h.csv")
    with open(p, "w") as f:
        f.write(" Net ,NETWORK_NAME,valid_from,valid_to\naa,x,1900-01-01,9999-12-31\n")
    check_header(spark, p, ["net", "network_name", "valid_from", "valid_to"])
    with pytest.raises(HeaderMismatch):
        check_header(spark, p, ["net", "name", "valid_from", "valid_to"])
    # every file of a folder is checked
    d = os.path.join(workdir, "many")
    os.makedirs(d)
    for k, head in enumerate(("x,y", '"X", y', "y,x")):
        with open(os.path.join(d, f"{k}.csv"), "w") as f:
            f.write(head + "\n1,2\n3,4\n")
        if k < 2:
            check_header(spark, d, ["x", "y"])
    with pytest.raises(HeaderMismatch):
        check_header(spark, d, ["x", "y"])


def test_manifest_optional_keys_and_union_order(spark, workdir):
    sl = qf.slices(workdir, ["dup", "overlap"])
    assert read_manifest(spark, sl[2][1])["events_file"] is None
    ev, hist = load_raw(spark, sl)
    orders = sorted({(r["_slice_id"], r["_slice_order"]) for r in ev.collect()})
    assert orders == [("baseline", 0), ("dup", 1)]
    assert hist.filter("_slice_id = 'overlap'").count() == 1


def test_seed_sql_on_files_views_catalog(spark, workdir):
    seed = os.path.join(workdir, "mag_class.csv")
    with open(seed, "w") as f:
        f.write("class_key,class_name,mag_min,mag_max\n1,micro,-10,2\n2,minor,2,4\n")
    df = read_seed(spark, seed, "class_key int, class_name string, mag_min decimal(18,6), mag_max decimal(18,6)")
    pq = os.path.join(workdir, "pq")
    df.write.parquet(pq)
    assert sql_on_files(spark, "parquet", pq, "class_key = 2").first()["class_name"] == "minor"
    register_views(spark, {"mag_class": df})
    assert spark.sql("SELECT count(*) AS n FROM mag_class").first()["n"] == 2
    lk = literal_lookup(spark, "groups", [("(article)", "Main")], "namespace string, content_group string")
    assert spark.catalog.tableExists("groups") and lk.count() == 1
    assert ensure_database(spark, "strata_test_db") in (True, False)
    assert spark.catalog.databaseExists("strata_test_db")


def test_qa_snapshot_and_trace(spark, workdir):
    raw, _h = load_raw(spark, qf.slices(workdir + "/d", ["corrupt"]))
    p = snapshot(raw.select("id", "mag"), workdir + "/qa", "raw", "run1")
    assert read_snapshot(spark, workdir + "/qa", "raw", "run1").count() == 4 and p.endswith("raw_run1")
    failing = spark.createDataFrame([("feed", "bad-1")], "source_system string, event_id string")
    traced = trace_to_raw(failing, raw).collect()
    assert [(r["_slice_id"], r["_is_synthetic"]) for r in traced] == [("corrupt", True)]
