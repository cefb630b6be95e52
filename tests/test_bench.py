"""bench.py keeps its contract: one JSON line with metric, value, unit, queries, sf."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(
        os.environ,
        BENCH_SF_DIR="/root/testdata/sf0.001",
        BENCH_RUNS="1",
        BENCH_COMPARE="0",
        BENCH_QUERIES="client_calls,times_zone_rule",
        BENCH_DRIVER_MEMORY="2g",
    )
    proc = subprocess.run(
        [sys.executable, os.path.join(ROOT, "bench.py")], capture_output=True, text=True, timeout=600, env=env
    )
    assert proc.returncode == 0, proc.stderr[-2000:]
    lines = [l for l in proc.stdout.splitlines() if l.strip()]
    assert len(lines) == 1
    out = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(out)
    assert out["unit"] == "sec" and out["sf"] == 0.001
    assert set(out["queries"]) == {"client_calls", "times_zone_rule"}
    assert out["plan_stats"]["times_zone_rule"]["shuffle_bytes"] == 0
    assert 0 < out["plan_stats"]["client_calls"]["shuffle_bytes"] < 10_000  # the size check of the dimension alone
