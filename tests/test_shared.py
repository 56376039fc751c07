from types import SimpleNamespace

import pytest

from driftvault.sources import shared


def session(master, **conf):
    return SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: conf.get(k.replace(".", "_"), d)), sparkContext=SimpleNamespace(master=master, applicationId=master))


def test_the_root_is_one_that_all_share():
    assert shared.shared_root(session("yarn", spark_checkpoint_dir="hdfs://h/x/")) == "hdfs://h/x"
    assert shared.shared_root(session("yarn", spark_sql_warehouse_dir="s3a://b/w")) == "s3a://b/w/_driftvault"
    for master in ("yarn", "local-cluster[3,2,1000]", "spark://host:7077"):
        for warehouse in ("file:/w", "/w", "spark-warehouse"):
            with pytest.raises(ValueError):
                shared.shared_root(session(master, spark_sql_warehouse_dir=warehouse))
    local = session("local[2]", spark_sql_warehouse_dir="file:/w")
    assert shared.shared_root(local).startswith("file:///") and shared.shared_root(local) == shared.shared_root(local)


def test_release_deletes_what_came_after_the_mark(spark):
    paths = []
    for k in range(4):
        if k == 1:
            before = shared.mark()
        paths.append(shared.shared_folder(spark, f"t{k}"))
        spark.range(3).write.parquet(paths[-1])
    assert shared.latest() == paths[3] and shared.release(spark, before, keep=(paths[3],)) == 2
    assert [spark.read.parquet(p).count() for p in (paths[0], paths[3])] == [3, 3]
    for p in paths[1:3]:
        with pytest.raises(Exception):  # noqa: B017
            spark.read.parquet(p)
    assert shared.mark() == before + 1 and shared.release(spark, before) == 1
