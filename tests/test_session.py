"""Scratch space."""

from types import SimpleNamespace

import pytest

from tidemark.session import scratch_dir


def _session(master, folder=None):
    conf = SimpleNamespace(get=lambda key, default: folder if key == "spark.checkpoint.dir" else default)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))


def test_shared_folder_is_used_everywhere():
    for master in ("yarn", "local[2]"):
        first, second = (scratch_dir(_session(master, "s3a://bucket/scratch/"), "x") for _ in range(2))
        assert first.startswith("s3a://bucket/scratch/x-") and first != second


def test_a_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(_session("yarn"), "x")


def test_local_mode_falls_back_to_this_machine():
    assert scratch_dir(_session("local[2]"), "x").startswith("/")
