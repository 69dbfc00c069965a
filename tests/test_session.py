import os
from types import SimpleNamespace

import pytest

from ticklake import session


def _fake(master):
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: None, setCheckpointDir=lambda d: None)
    return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda k, d=None: d, set=lambda k, v: None))


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "k8s://x", "local-cluster[2,1,1024]"])
def test_a_cluster_without_a_shared_folder_is_an_error(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.checkpoint_root(_fake(master))


def test_a_local_master_gets_a_folder():
    assert os.path.isdir(session.checkpoint_root(_fake("local[2]")))


def test_scratch_is_removed_on_request(spark, monkeypatch):
    monkeypatch.setattr(session, "_SCRATCH", {})
    df = session.materialize(spark.range(3), "numbers")
    path = session._SCRATCH[spark.sparkContext.applicationId][0]
    local = path[5:] if path.startswith("file:") else path
    assert df.count() == 3 and os.path.isdir(local)
    assert session.remove_scratch(spark) == 1 and not os.path.isdir(local)
    assert session.remove_scratch(spark) == 0
