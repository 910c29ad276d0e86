"""Where intermediates go."""

from types import SimpleNamespace

import pytest

from terraflux.llm.shared import discard, materialise, shared_dir, temporary


def session(master, conf):
    return SimpleNamespace(sparkContext=SimpleNamespace(master=master), conf=SimpleNamespace(get=lambda key, *default: conf.get(key, *default)))


def test_folder():
    warehouse = {"spark.sql.warehouse.dir": "file:/w/"}
    assert shared_dir(session("spark://x:1", warehouse | {"spark.checkpoint.dir": "hdfs://a/b/"})) == "hdfs://a/b"
    assert shared_dir(session("local", warehouse)) == shared_dir(session("local[8]", warehouse)) == "file:/w/_checkpoint"
    for master in ("spark://x:1", "yarn", "local-cluster[2,1,1024]", "k8s://x"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_dir(session(master, warehouse))


def exists(df):
    path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.inputFiles()[0])
    return path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).exists(path)


def test_intermediates_go(spark):
    with temporary():
        first = materialise(spark.range(5), "first")
        kept = materialise(first.filter("id > 1"), "kept", keep=True)
        discard(materialise(first, "gone-already"))
        assert exists(first)
    later = materialise(spark.range(2), "later")
    assert not exists(first) and exists(kept) and exists(later) and kept.count() == 3
