"""Shared scratch location: the session's checkpoint folder, never a guess."""

import pytest

from velolake import session as SS


class _Conf(dict):
    def get(self, key, default=None):  # SparkConf.get signature
        return super().get(key, default)


class _SC:
    def __init__(self, current=None, conf=None):
        self.current, self.conf = current, _Conf(conf or {})

    def getCheckpointDir(self):
        return self.current

    def getConf(self):
        return self.conf

    def setCheckpointDir(self, path):
        self.current = path


class _Spark:
    def __init__(self, sc):
        self.sparkContext = sc


def test_uses_session_checkpoint_dir():
    assert SS.checkpoint_root(_Spark(_SC("hdfs://nn/ckpt/abc"))) == "hdfs://nn/ckpt/abc"


def test_falls_back_to_configured_dir():
    sc = _SC(None, {"spark.checkpoint.dir": "s3a://bucket/ckpt"})
    assert SS.checkpoint_root(_Spark(sc)) == "s3a://bucket/ckpt"


def test_refuses_to_guess(monkeypatch):
    monkeypatch.delenv("VELOLAKE_CHECKPOINT_DIR", raising=False)
    with pytest.raises(RuntimeError):
        SS.checkpoint_root(_Spark(_SC()))
    assert SS.checkpoint_root(_Spark(_SC()), fallback="/shared/x") == "/shared/x"


def test_scratch_paths_are_unique(spark):
    a, b = SS.scratch_path(spark, "q"), SS.scratch_path(spark, "q")
    assert a != b and a.startswith(SS.checkpoint_root(spark).rstrip("/"))
