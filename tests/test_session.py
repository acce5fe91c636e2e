from __future__ import annotations

from types import SimpleNamespace

import pytest

from tallylake.session import scratch_dir


def session(master: str, shared: str | None):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: shared),
        sparkContext=SimpleNamespace(master=master),
    )


def test_scratch_lies_in_the_shared_folder():
    one, two = (scratch_dir(session("yarn", "hdfs://a/b/"), "x") for _ in range(2))
    assert one.startswith("hdfs://a/b/x-") and one != two


def test_no_machine_folder_on_a_cluster():
    with pytest.raises(ValueError):
        scratch_dir(session("yarn", None), "x")
    assert "tallylake-" in scratch_dir(session("local[4]", None), "x")
