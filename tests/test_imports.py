import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent


def test_imports_need_no_session():
    mods = ["__spark_entry__", "rillwork.plans.jobs", "rillwork.streaming.state",
            "rillwork.streaming.lookups", "rillwork.sources.synth"]
    code = "import " + ", ".join(mods)
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)
