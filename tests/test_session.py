import pytest

from placewise.session import on_one_machine, work_folder


def test_work_folders_lie_in_the_shared_folder(spark, tmp_path, monkeypatch):
    conf = type(spark.conf)
    plain = conf.get
    monkeypatch.setattr(conf, "get", lambda self, key, *default: f"file://{tmp_path}/" if key == "spark.checkpoint.dir" else plain(self, key, *default))
    first, second = work_folder(spark, "a"), work_folder(spark, "a")
    assert first.startswith(f"file://{tmp_path}/placewise/a-") and first != second
    spark.range(3).write.parquet(first)
    assert spark.read.parquet(first).count() == 3


def test_without_a_shared_folder_the_warehouse_serves(spark):
    if not spark.conf.get("spark.checkpoint.dir", None):
        assert work_folder(spark, "a").startswith(spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/placewise/")


def test_a_cluster_without_a_shared_folder_is_refused(spark, monkeypatch):
    conf = type(spark.conf)
    plain = conf.get
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]", "k8s://https://host"):
        own = {"spark.checkpoint.dir": None, "spark.master": master, "spark.sql.warehouse.dir": "file:/one/machine"}
        monkeypatch.setattr(conf, "get", lambda self, key, *default, own=own: own[key] if key in own else plain(self, key, *default))
        with pytest.raises(ValueError, match="set spark.checkpoint.dir"):
            work_folder(spark, "a")
    assert not on_one_machine("hdfs://names/warehouse") and on_one_machine("/warehouse") and on_one_machine("spark-warehouse")
