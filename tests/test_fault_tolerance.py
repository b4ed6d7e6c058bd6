import json
import os
import subprocess
import sys

SCRIPT = os.path.join(os.path.dirname(os.path.abspath(__file__)), "scripts", "retry_determinism.py")


def test_retried_tasks_give_identical_results():
    out = subprocess.run([sys.executable, SCRIPT], capture_output=True, text=True, timeout=600)
    lines = [ln for ln in out.stdout.splitlines() if ln.startswith("{")]
    assert lines, out.stderr[-2000:]
    res = json.loads(lines[-1])
    assert res == {"map_side_equal": True, "reduce_side_equal": True, "fit_equal": True, "weights": 400.0}
