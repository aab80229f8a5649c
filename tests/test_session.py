"""Checkpoint-folder policy and approximate distinct counts."""

import pytest
from webledger.operators import cost
from webledger.session import ensure_checkpoint_dir
from webledger.sources.fixtures import Views


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _Context:
    def __init__(self, master, current=None, conf=None):
        self.master, self._dir, self._conf = master, current, _Conf(conf or {})

    def getCheckpointDir(self):
        return self._dir

    def setCheckpointDir(self, d):
        self._dir = d

    def getConf(self):
        return self._conf


class _Session:
    def __init__(self, master, current=None, conf=None):
        self.sparkContext = _Context(master, current, conf)
        self.conf = _Conf(conf or {})


def test_cluster_setting_wins_and_cluster_without_one_refuses():
    s = _Session("spark://cluster:7077", conf={"spark.checkpoint.dir": "hdfs:///shared/ckpt"})
    assert ensure_checkpoint_dir(s) == "hdfs:///shared/ckpt"
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(_Session("spark://cluster:7077"))
    assert ensure_checkpoint_dir(_Session("local[2]")).startswith("/")  # local only: a scratch folder
    assert ensure_checkpoint_dir(_Session("yarn", current="hdfs:///already")) == "hdfs:///already"


def test_approximate_distinct_urls_within_bound(spark, sf):
    v = Views(spark, sf)
    pages = v.table("pages").select("page_id", "url")
    f = cost.priced_requests(v.requests).join(pages, "page_id")
    exact = {r.account_id: r.distinct_urls for r in cost.distinct_urls(f).collect()}
    approx = {r.account_id: r.approx_urls for r in cost.distinct_urls(f, approximate=True, rsd=0.02).collect()}
    assert exact.keys() == approx.keys()
    assert all(abs(approx[k] - exact[k]) <= max(1, 0.06 * exact[k]) for k in exact)  # 3 sigma at rsd 2%
