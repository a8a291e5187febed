"""The engine loads and runs whatever the working directory is."""

import os
import subprocess
import sys
import textwrap

import __spark_entry__ as entry

REPO = os.path.dirname(os.path.abspath(entry.__file__))


def test_queries_and_oracles_need_no_session_or_jar(monkeypatch):
    import glob
    monkeypatch.setattr(glob, "glob", lambda *a, **k: [])
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) >= 71


def test_workers_find_the_package_from_another_folder(tmp_path):
    code = textwrap.dedent(f"""
        import sys
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
                 .config("spark.sql.shuffle.partitions", "4").getOrCreate())
        sys.path.insert(0, {REPO!r})
        import __spark_entry__ as e
        for q in ("p3_lexicon_sentiment", "f6_temporal_forecast"):
            assert e.queries()[q](spark, "/root/testdata/sf0.001").count() > 0
        print("fine")
    """)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True,
                         text=True, timeout=300)
    assert "fine" in out.stdout, out.stderr[-2000:]
