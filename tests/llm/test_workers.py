"""The tasks run where only the driver has the package."""

from __future__ import annotations

import os
import subprocess
import sys

QUERIES = ["op4_language_id", "op9_lm_score", "op10_decontaminate", "op11_repair_conversations", "op12_align_tokens", "op13_toxicity"]

CODE = """
import sys
sys.path.insert(0, sys.argv[1])
from eventmart.session import local_session
from eventmart.llm.queries import queries
spark = local_session(4, "alone", **{"spark.checkpoint.dir": sys.argv[3], "spark.sql.shuffle.partitions": "2"})
def has_it(batches):
    import importlib.util
    for batch in batches:
        batch["found"] = importlib.util.find_spec("eventmart") is not None
        yield batch[["found"]]
assert not spark.range(1).mapInPandas(has_it, "found boolean").first()[0]
for name in sys.argv[4:]:
    assert queries()[name](spark, sys.argv[2]).count() > 0
print("all ran")
"""


def test_executors_need_no_copy_of_the_package(sf_dir, tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", CODE, root, sf_dir, str(tmp_path / "shared"), *QUERIES],
        cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900, check=False,
    )
    assert "all ran" in done.stdout, done.stderr[-3000:]
