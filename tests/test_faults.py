"""Lost tasks are retried from lineage (or the checkpoint) with identical results."""

from __future__ import annotations

import json
import os
import subprocess
import sys
import tempfile


def test_failed_tasks_are_retried_with_identical_results():
    script = os.path.join(os.path.dirname(os.path.abspath(__file__)), "fault_script.py")
    markers = tempfile.mkdtemp(prefix="faults-")
    proc = subprocess.run(
        [sys.executable, script, "/root/testdata/sf0.001"],
        capture_output=True,
        text=True,
        timeout=600,
        env={**os.environ, "FAULT_MARKERS": markers},
    )
    last = [line for line in proc.stdout.splitlines() if line.startswith("{")]
    assert last, proc.stderr[-2000:]
    res = json.loads(last[-1])
    assert res["none"] and res["checkpoint"]
    assert res["injected_failures"] >= 2  # at least one failed attempt per build really happened
