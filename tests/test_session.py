"""Work folders come from the session's spark.checkpoint.dir; every run gets a new one."""
from lakeward.session import cluster_conf, fresh_dir, work_dir


def test_work_dir_reads_session_setting(spark):
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    wd = work_dir(spark)
    assert wd and (base is None or wd.rstrip("/").endswith(base.split(":", 1)[-1].rstrip("/"))
                   or base.rstrip("/").endswith(wd.rstrip("/")))
    a, b = fresh_dir(spark, "x"), fresh_dir(spark, "x")
    assert a != b and a.startswith(wd) and b.startswith(wd)


def test_cluster_conf_scales_with_input():
    small = cluster_conf(10 * 1024 ** 2, 64)
    big = cluster_conf(100 * 1024 ** 4, 8000)   # 100 TB, 8000 cores
    assert int(small["spark.sql.shuffle.partitions"]) == 128
    assert int(big["spark.sql.shuffle.partitions"]) == 100 * 1024 ** 4 // (128 * 1024 ** 2) + 1
