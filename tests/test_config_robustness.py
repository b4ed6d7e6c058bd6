import json
import os
import subprocess
import sys

import pytest

SCRIPT = os.path.join(os.path.dirname(os.path.abspath(__file__)), "scripts", "other_config.py")


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="driver test data not present")
def test_queries_under_an_unusual_session_config():
    # local[2], 37 shuffle partitions, AQE off, ANSI off, 7-row Arrow batches, no auto-broadcast
    out = subprocess.run([sys.executable, SCRIPT], capture_output=True, text=True, timeout=1200)
    lines = [ln for ln in out.stdout.splitlines() if ln.startswith("{")]
    assert lines, out.stderr[-3000:]
    res = json.loads(lines[-1])
    assert res["mismatches"] == [] and res["n"] >= 32
