from __future__ import annotations

import os
from types import SimpleNamespace

import pytest

from telemaque.workspace import fresh_dir, shared_root


def session(**settings):
    return SimpleNamespace(conf=_Conf(settings))


class _Conf:
    def __init__(self, settings):
        self._settings = {key.replace("_", "."): value for key, value in settings.items()}

    def get(self, key, default=None):
        return self._settings.get(key, default)


def test_the_clusters_folder_is_used():
    root = "s3a://bucket/shared"
    paths = {fresh_dir(session(spark_checkpoint_dir=root + "/", spark_master="yarn"), "x") for _ in range(5)}
    assert len(paths) == 5 and all(p.startswith(f"{root}/telemaque/x-") for p in paths)


def test_no_machine_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_root(session(spark_master="spark://master:7077"))


def test_a_temporary_folder_in_local_mode():
    assert os.path.isdir(shared_root(session(spark_master="local[2]")))


def test_the_session_answers(spark):
    assert fresh_dir(spark, "x") != fresh_dir(spark, "x")
