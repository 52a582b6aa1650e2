from types import SimpleNamespace

import pytest

from creditecho.session import shared_folder


def session(master, **conf):
    get, put = conf.get, conf.__setitem__
    return SimpleNamespace(conf=SimpleNamespace(get=get, set=put), sparkContext=SimpleNamespace(master=master))


def test_a_cluster_must_name_its_shared_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(session("spark://host:7077"))
    assert shared_folder(session("spark://host:7077", **{"spark.checkpoint.dir": "hdfs://store/tmp/"})) == "hdfs://store/tmp"


def test_one_local_folder_per_session():
    local = session("local[2]")
    assert shared_folder(local) == shared_folder(local)
