import json
import os
import subprocess
import sys
from pathlib import Path

from ledgerloom.plans.business import QUESTIONS


def test_the_bench_prints_one_line_of_figures():
    """In a process of its own, as it makes its own session."""
    settings = os.environ | {"BENCH_SF_DIR": "/root/testdata/sf0.001", "BENCH_CPUS": "4", "BENCH_MEMORY": "2g"}
    bench = Path(__file__).resolve().parents[1] / "bench.py"
    done = subprocess.run([sys.executable, bench], env=settings, capture_output=True, text=True, timeout=900)
    assert done.returncode == 0, done.stderr[-2000:]
    report = json.loads(done.stdout.strip().splitlines()[-1])
    assert {"daily_load", "daily_load_rerun", "q6b_variants", *QUESTIONS} <= set(report["queries"])
    assert report["value"] > 0 and report["sf"] == "0.001"
