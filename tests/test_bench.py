"""bench.py prints exactly one JSON line with per-query timings."""
import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line(sf_dir):
    env = dict(os.environ, BENCH_SF_DIR=sf_dir, BENCH_CPUS="2", BENCH_REPEATS="1",
               BENCH_QUERIES="branch_kpis,daily_revenue_all")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, cwd=ROOT,
                         capture_output=True, text=True, timeout=600, check=True).stdout
    lines = [ln for ln in out.splitlines() if ln.strip()]
    assert len(lines) == 1
    d = json.loads(lines[0])
    assert d["unit"] == "sec" and d["sf"] == 0.001 and set(d["queries"]) == {"branch_kpis", "daily_revenue_all"}
    assert d["value"] == round(sum(d["queries"].values()), 3)
