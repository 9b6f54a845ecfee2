from types import SimpleNamespace

import pytest

from tillhouse.llm import shared


def session(master, folder=None):
    context = SimpleNamespace(master=master, applicationId=f"app-{master}")
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: folder or default), sparkContext=context)


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "local-cluster[3,2,1024]", "k8s://x"])
def test_a_cluster_needs_a_shared_folder(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared.shared_folder(session(master))
    assert shared.shared_folder(session(master, "hdfs:///work")) == "hdfs:///work"


@pytest.mark.parametrize("master", ["local", "local[8]", "local[*]"])
def test_one_machine_has_a_folder_of_its_own(master):
    found = shared.shared_folder(session(master))
    assert found.startswith("/tmp/run-") and shared.shared_folder(session(master)) == found
