import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

#: A session of its own: the one of the other tests has the setting.
UNSET = """
from pyspark.sql import SparkSession
from folio.llm import near_dedup
from folio.llm.common import shared_dir, written
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
assert not spark.conf.get("spark.checkpoint.dir", None)
assert shared_dir(spark) == shared_dir(spark)
assert written(spark.range(3), "t").count() == 3
docs = spark.createDataFrame([(1, "a b c d e f g"), (2, "a b c d e f g"), (3, "x y z")], "doc_id long, text string")
print("KEPT", sorted(r.doc_id for r in near_dedup.without_copies(docs).collect()))
"""


def test_operators_run_without_a_checkpoint_setting(tmp_path):
    out = subprocess.run([sys.executable, "-c", UNSET], cwd=ROOT, env=os.environ | {"PYTHONPATH": ROOT, "SPARK_CONF_DIR": str(tmp_path)}, capture_output=True, text=True, timeout=300)
    assert "KEPT [1, 3]" in out.stdout, out.stderr[-2000:]
