from types import SimpleNamespace

import pytest

from crewlens.llm.shared import RANGE_BYTES, hash_ranges, shared_dir


def session(master, **conf):
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: conf.get(key, default), set=conf.__setitem__), sparkContext=SimpleNamespace(master=master))


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(session("spark://host:7077"))
    assert shared_dir(session("yarn", **{"spark.checkpoint.dir": "hdfs:///tmp/x"})) == "hdfs:///tmp/x"
    local = session("local[2]")
    assert shared_dir(local) == shared_dir(local)


def test_ranges_follow_the_bytes_that_are_sent():
    few = session("local[2]", **{"spark.sql.shuffle.partitions": "51"})
    assert hash_ranges(few, 0) == hash_ranges(few, 1e9) == 64
    for sent in (1e10, 1e12, 1e14):
        n = hash_ranges(few, sent)
        assert n & (n - 1) == 0 and RANGE_BYTES / 2 < sent / n <= RANGE_BYTES
