import os
import subprocess
import sys

from cartolux.runtime import Stage, fits_broadcast, salted_join, shared_dir
from pyspark.sql import functions as F

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_the_cluster_names_the_shared_folder(tmp_path):
    code = f"""
from cartolux.runtime import Stage, session, shared_dir
s = session(cores=1, **{{"spark.checkpoint.dir": "file://{tmp_path}/shared"}})
assert shared_dir(s) == "file://{tmp_path}/shared", shared_dir(s)
assert Stage(s).write(s.range(3)).count() == 3
import os
assert any(x.startswith("cartolux-") for x in os.listdir("{tmp_path}/shared"))
"""
    run = subprocess.run([sys.executable, "-c", code], cwd=ROOT, env=os.environ | {"PYTHONPATH": ROOT}, capture_output=True, text=True, timeout=180)
    assert run.returncode == 0, run.stderr[-800:]
    assert not [x for x in os.listdir(f"{tmp_path}/shared") if x.startswith("cartolux-")]


def test_stage(spark):
    stage = Stage(spark)
    a = stage.write(spark.range(5).withColumn("x", F.lit(None).cast("string")))
    assert a.count() == 5 and shared_dir(spark) in stage.root
    stage.drop(a)
    assert not os.path.exists(a.staged_path.removeprefix("file://"))


def test_salted_join_gives_the_plain_join(spark):
    big = spark.createDataFrame([(i % 3 if i % 2 else None, i) for i in range(300)], "k long, v long")
    small = spark.createDataFrame([(0, "a"), (1, "b"), (None, "n")], "k long, w string")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    for threshold in (limit, "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        for how in ("inner", "left"):
            want = sorted(map(str, big.join(small, "k", how).collect()))
            assert sorted(map(str, salted_join(big, small, ["k"], [F.col("v")], how).select("k", "v", "w").collect())) == want
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert fits_broadcast(small, 3) and not fits_broadcast(small, 2)


def test_no_machine_local_folder_on_a_cluster():
    import pytest

    from cartolux.runtime import shared_dir

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError):
        shared_dir(Session())
