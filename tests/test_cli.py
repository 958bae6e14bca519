"""The command-line runner."""
import os
import tempfile

from branchlens.plans import run


def test_list(capsys):
    assert run.main(["--list"]) == 0
    names = capsys.readouterr().out.split()
    assert "branch_kpis" in names and len(names) == 67


def test_unknown_query():
    assert run.main(["no_such_query"]) == 2


def test_run_and_write(spark, sf_dir):
    out = os.path.join(tempfile.mkdtemp(prefix="branchlens-cli-"), "kpis")
    assert run.main(["branch_kpis", "--sf-dir", sf_dir, "--out", out]) == 0
    assert spark.read.parquet(out).filter("branch = 'ALL'").count() == 1
