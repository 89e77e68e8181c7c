import os
import subprocess
import sys


def test_tasks_that_die_do_not_change_results(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run(
        [sys.executable, "-m", "tests.lossy_run", str(tmp_path / "run")],
        cwd=root, capture_output=True, text=True, timeout=300,
    )
    assert "same result" in done.stdout, done.stderr[-3000:]
