"""Python workers get all helper code with the job, without an installed copy."""

import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parents[1]

SCRIPT = """
import sys
sys.path.insert(0, sys.argv[1])
import __spark_entry__ as contract
from pyspark.sql import SparkSession

spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
for name in ("imagecap", "score_head", "encode_json", "fetch_url", "map_batches", "collate_fn"):
    contract.queries()[name](spark, "/root/testdata/sf0.001").write.format("noop").mode("overwrite").save()
print("shipped")
"""


def test_workers_need_no_installed_package(tmp_path):
    (tmp_path / "run.py").write_text(SCRIPT)
    done = subprocess.run(
        [sys.executable, "run.py", str(REPO)], cwd=tmp_path, capture_output=True, text=True, timeout=300,
        env={"PATH": "/usr/bin:/bin", "HOME": str(tmp_path), **_java()},
    )
    assert "shipped" in done.stdout, done.stderr[-2000:]


def _java() -> dict[str, str]:
    import os

    return {k: v for k, v in os.environ.items() if k in ("JAVA_HOME", "PATH")}
