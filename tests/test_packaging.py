"""Tasks run where the package cannot be imported, as on executors without a copy of it."""

import os
import subprocess
import sys
from pathlib import Path

SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
from merchlens.operators import factorization, similarity
rows = [(i, [1.0, float(i)]) for i in range(6)]
vectors = spark.createDataFrame(rows, "product_id INT, features ARRAY<DOUBLE>")
print("pairs", similarity.similar_products(vectors, 0.4).count())
users = spark.createDataFrame([(1, [1.0, 1.0], 2)], "user_id INT, features ARRAY<FLOAT>, depth INT")
items = spark.createDataFrame([(i, [1.0, float(i)]) for i in range(4)], "product_id INT, features ARRAY<FLOAT>")
print("best", factorization.best_products(users, items).count())
"""


def test_tasks_need_no_installed_copy(tmp_path):
    script = SCRIPT.format(root=str(Path(__file__).resolve().parents[1]))
    done = subprocess.run(
        [sys.executable, "-c", script], cwd=tmp_path, capture_output=True, text=True, timeout=180,
        env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"},
    )
    assert "best 2" in done.stdout, done.stderr[-2000:]
