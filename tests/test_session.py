"""The shared working folder comes from the session's spark.checkpoint.dir."""

from __future__ import annotations

import pytest

from stockledger.session import shared_dir


def test_shared_dir_is_under_the_checkpoint_dir(spark):
    base = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    a, b = shared_dir(spark, "x"), shared_dir(spark, "x")
    assert a != b  # a fresh folder per call: runs never clean up after each other
    if base:
        assert a.startswith(base)
    assert spark.sparkContext.getCheckpointDir()  # set when it was missing (local tests)


def test_no_machine_local_folder_on_a_cluster():
    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda key, default=None: default)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(Session(), "x")
