"""The driver contract: entry runs, every query has an oracle, smoke at sf0.001."""

import __spark_entry__ as E
from tickspark.plans.catalog import QUERIES
from tickspark.plans.oracle import ORACLE


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["RIC", "VWAP", "TWAP", "TotalVolume", "NumTrades"]
    assert len(rows) == 3


def test_every_query_has_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())
    assert set(E.oracle_sql()) <= set(E.queries())


def test_all_queries_run_at_smallest_scale(spark):
    for name in QUERIES:
        df = E.queries()[name](spark, "/root/testdata/sf0.001")
        df.collect()


def test_entry_without_the_corpus_subpackage(tmp_path):
    """The driver deletes corpus_pipeline.py and the llm folder: the rest still imports."""
    import shutil
    import subprocess
    import sys
    from pathlib import Path
    repo = Path(__file__).resolve().parents[1]
    shutil.copytree(repo / "tickspark", tmp_path / "tickspark", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(repo / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as E; assert 'vwap_pivot' in E.queries() and set(E.oracle_sql()) == set(E.queries())"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr[-2000:]


def test_queries_independent_of_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        rows = E.queries()["scenarios"](spark, "/root/testdata/sf0.001").where("SCENARIO_ID = 1").collect()
        assert str(rows[0].END_DATE) == "2024-01-31 00:00:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_scale_conf_sizes_partitions():
    from tickspark.session import scale_conf
    c = scale_conf(100 * 1024 ** 4, total_cores=8000)
    assert int(c["spark.sql.shuffle.partitions"]) == 409600
    assert int(scale_conf(1024, total_cores=16)["spark.sql.shuffle.partitions"]) == 32


def test_worker_code_runs_without_the_package_on_workers(tmp_path):
    """Import the entry file by path from another directory (workers cannot
    import tickspark there) and run the queries whose code executes in
    Python workers."""
    import subprocess
    import sys
    from pathlib import Path
    repo = Path(__file__).resolve().parents[1]
    code = f"""
import importlib.util, sys
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
sys.path.insert(0, {str(repo)!r})
spec = importlib.util.spec_from_file_location("spark_entry", {str(repo / "__spark_entry__.py")!r})
m = importlib.util.module_from_spec(spec); spec.loader.exec_module(m)
assert m.queries()["report_text"](spark, "/root/testdata/sf0.001").count() == 3
print("ok")
"""
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert out.returncode == 0 and "ok" in out.stdout, out.stderr[-2000:]
