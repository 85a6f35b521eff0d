"""bench.py's contract: exactly one JSON line on stdout with metric, value,
unit, queries and sf."""

import json
import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_bench_prints_one_json_line():
    env = {**os.environ, "BENCH_SF_DIR": SF, "BENCH_CPUS": "2",
           "BENCH_QUERIES": "period_bounds,quality_nulls", "BENCH_DRIVER_MEMORY": "2g"}
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env,
                         capture_output=True, text=True, timeout=600, check=True).stdout
    lines = [x for x in out.splitlines() if x.strip()]
    assert len(lines) == 1
    d = json.loads(lines[0])
    assert d["unit"] == "sec" and d["sf"] == 0.001 and "errors" not in d
    assert set(d["queries"]) == {"period_bounds", "quality_nulls"}
    assert d["value"] == pytest.approx(sum(d["queries"].values()), abs=0.01)
