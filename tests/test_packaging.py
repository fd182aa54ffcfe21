"""Queries that run Python on executors work from any working directory."""

import os
import subprocess
import sys
import textwrap

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_python_routes_from_another_directory(tmp_path):
    script = textwrap.dedent(
        f"""
        import importlib.util
        spec = importlib.util.spec_from_file_location("entry", {os.path.join(REPO, "__spark_entry__.py")!r})
        E = importlib.util.module_from_spec(spec); spec.loader.exec_module(E)
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
                 .config("spark.sql.shuffle.partitions", "4").getOrCreate())
        spark.sparkContext.setLogLevel("ERROR")
        for key in ("stream_assemble_segments", "custom_splitter_python"):
            print(key, E.queries()[key](spark, "/root/testdata/sf0.001").count())
        """
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run(
        [sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600
    )
    assert out.returncode == 0, out.stderr[-2000:]
    assert "stream_assemble_segments 200" in out.stdout and "custom_splitter_python 400" in out.stdout
