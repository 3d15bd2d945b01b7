"""bench.py runs end to end and prints one JSON line of the agreed shape."""

import json
import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF, BENCH_CPUS="4", BENCH_REPEAT="1")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, cwd=ROOT,
                         capture_output=True, text=True, timeout=900)
    assert out.returncode == 0, out.stderr[-2000:]
    lines = [l for l in out.stdout.splitlines() if l.strip()]
    assert len(lines) == 1
    res = json.loads(lines[0])
    assert res["unit"] == "sec" and res["sf"] == 0.001 and res["value"] > 0
    assert set(res["queries"]) >= {"fact_sales", "dim_customer", "dim_product", "stored_csv_to_gold"}
    assert res["stored_run_failed_tables"] == 0
    fact = res["large_dimensions"]["fact_sales"]
    assert 1 <= fact["shuffles"] <= fact["reference_shuffles"]
    assert set(res["skew"]) == {"repeat", "repeat_plain", "keep", "keep_plain"}
