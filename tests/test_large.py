import os
import subprocess
import sys


def test_hundred_thousand_lines_do_not_end_the_jvm():
    script = os.path.join(os.path.dirname(os.path.abspath(__file__)), "large_logs.py")
    done = subprocess.run([sys.executable, script], capture_output=True, text=True, timeout=600)
    assert "large logs ok" in done.stdout, done.stderr[-3000:]
