"""bench.py prints exactly one JSON line with the fields the driver records."""

import json
import os
import subprocess
import sys

from .conftest import SF001

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = {**os.environ, "BENCH_SF_DIR": SF001, "BENCH_CPUS": "2", "BENCH_QUERIES": "dim_date,monthly_kpis"}
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, cwd=ROOT,
                         capture_output=True, text=True, timeout=600)
    lines = [ln for ln in out.stdout.splitlines() if ln.strip()]
    assert len(lines) == 1, out.stdout
    d = json.loads(lines[0])
    assert d["unit"] == "sec" and d["sf"] == 0.001 and "errors" not in d
    assert set(d["queries"]) == {"model_build", "dim_date", "monthly_kpis"}
    assert abs(d["value"] - sum(d["queries"].values())) < 1e-6
