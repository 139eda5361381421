"""The command line drives a whole run on the reference's folder layout."""

import os

import quake_fixtures as qf
from strata.cli import main


def test_elt_then_report(spark, workdir, capsys):
    data = os.path.join(workdir, "data")
    qf.write_slice(data, "slice", "feed", False, qf.BASELINE_ROWS, qf.BASE_HISTORY)
    tests = os.path.join(data, "tests")
    qf.write_slice(tests, "late", "feed", True, qf.LATE_ROWS)
    qf.write_slice(tests, "corrupt", "feed", True, qf.CORRUPT_ROWS)
    root = os.path.join(workdir, "wh")
    assert main(["elt", "--data", data, "--root", root, "--start", qf.WINDOW[0], "--end", qf.WINDOW[1], "--run-id", "r1"]) == 0
    assert main(["elt", "--data", data, "--root", root, "--start", qf.WINDOW[0], "--end", qf.WINDOW[1], "--cases", "corrupt", "--run-id", "r2"]) == 1
    assert main(["elt", "--data", data, "--root", root, "--start", qf.WINDOW[0], "--end", qf.WINDOW[1], "--cases", "late", "--run-id", "r3"]) == 0
    out = capsys.readouterr().out
    assert "PASS=32 ERROR=0" in out and "PASS=29 ERROR=3" in out
    assert "not published" in out and "rows=1" in out
    assert main(["report", "--root", root]) == 0


def test_pageviews_command(spark, workdir, capsys):
    import gzip
    d = os.path.join(workdir, "dumps")
    os.makedirs(d)
    for name, lines in (("pageviews-20150501-010000.gz", ["en Main_Page 5 0", "en Special:Search 7 0", "de X 1 0"]),
                        ("pageviews-20150501-020000.gz", ["en Talk:Foo 3 0"])):
        with gzip.open(os.path.join(d, name), "wb") as f:
            f.write(("\n".join(lines) + "\n").encode())
    assert main(["pageviews", "--dumps", d, "--root", os.path.join(workdir, "out"),
                 "--lookup", "(article)=Main"]) == 0
    out = capsys.readouterr().out
    assert "Special" in out and "Talk" in out and "Main" in out
