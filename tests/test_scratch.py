import os
import subprocess
import sys
import time
from pathlib import Path
from types import SimpleNamespace

import pytest

from medallion.sources.scratch import Scratch, application_folder, release, scratch_root, scratch_scope


def session(folder, master):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: folder or default),
        sparkContext=SimpleNamespace(master=master, applicationId=f"app-{folder}-{master}"),
    )


def test_the_configured_folder_is_used_on_any_master():
    assert scratch_root(session("hdfs://shared/", "yarn")) == "hdfs://shared"
    assert scratch_root(session("/mnt/shared", "local[2]")) == "/mnt/shared"


def test_a_cluster_without_shared_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_root(session(None, "yarn"))


def test_a_local_session_keeps_one_temporary_folder():
    local = session(None, "local[2]")
    assert scratch_root(local) == scratch_root(local)


def test_scratch_drops_only_its_own_folder(spark):
    kept = Scratch(spark, "kept")
    table = kept.keep(spark.range(10), "t")
    with Scratch(spark, "gone") as scratch:
        scratch.keep(spark.range(5), "t")
        assert scratch.path != kept.path
    assert table.count() == 10
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(scratch.location("t")).count()


def test_release_drops_all_folders_of_the_application(spark):
    Scratch(spark, "some").keep(spark.range(3), "t")
    folder = application_folder(spark)
    assert os.path.isdir(folder)
    release(spark)
    assert not os.path.exists(folder)
    assert Scratch(spark, "again").keep(spark.range(3), "t").count() == 3


SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
from medallion.session import build_session
from verification.queries import QUERIES
spark = build_session("ends", "local[2]", spark__checkpoint__dir="file://" + sys.argv[1], spark__ui__enabled="false",
    spark__sql__shuffle__partitions="2", spark__sql__warehouse__dir=sys.argv[1] + "-warehouse")
for key in ("orders_row_number", "lookup_csv", "file_reduction"):
    assert QUERIES[key](spark, "/root/testdata/sf0.001").count() > 0
"""


def test_a_finished_application_leaves_nothing(tmp_path):
    root = tmp_path / "shared"
    root.mkdir()
    repo = str(Path(__file__).resolve().parents[1])
    subprocess.run([sys.executable, "-c", SCRIPT.format(repo=repo), str(root)], check=True, timeout=300)
    end = time.time() + 60  # the JVM outlives Python by a moment
    while any(p.name.startswith("medallion-") for p in root.iterdir()) and time.time() < end:
        time.sleep(0.5)
    assert [p for p in root.rglob("*") if p.is_file()] == []
    assert not any(p.name.startswith("medallion-") for p in root.iterdir())


def test_a_scope_drops_what_was_made_inside(spark):
    outer = Scratch(spark, "outer")
    kept = outer.keep(spark.range(3), "kept")
    with scratch_scope():
        inner = Scratch(spark, "inner")
        result = outer.keep(inner.keep(spark.range(5), "part"), "result")
        with scratch_scope():
            nested = Scratch(spark, "nested")
            nested.keep(spark.range(2), "part")
        assert not os.path.exists(nested.path) and os.path.exists(inner.path)
    assert not os.path.exists(inner.path)
    assert (kept.count(), result.count()) == (3, 5)
    outer.discard("kept")
    assert not os.path.exists(outer.location("kept")) and result.count() == 5


def test_a_scope_that_fails_drops_too(spark):
    with pytest.raises(KeyError), scratch_scope():
        inner = Scratch(spark, "failing")
        inner.keep(spark.range(2), "part")
        raise KeyError
    assert not os.path.exists(inner.path)
    after = Scratch(spark, "after")
    assert after.keep(spark.range(2), "part").count() == 2
