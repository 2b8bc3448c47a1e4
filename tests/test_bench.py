"""bench.py runs end to end and prints one JSON line (own process, own JVM)."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="4")
    proc = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, capture_output=True,
                          text=True, timeout=900, check=True)
    lines = [ln for ln in proc.stdout.splitlines() if ln.strip()]
    result = json.loads(lines[-1])
    assert result["metric"] == "pipeline_total_sec" and result["unit"] == "sec"
    assert result["value"] > 0 and "failed" not in result
    assert {"bronze_ingest", "silver_rebuild", "v_books", "ds_top_books", "enrich_round"} <= set(result["queries"])
