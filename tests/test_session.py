"""Where scratch tables go, and how intermediate results are stored."""

from __future__ import annotations

import os
import subprocess
import sys
from pathlib import Path
from types import SimpleNamespace

import pytest

from tradewake import session
from tradewake.sources import files


def fake(settings, checkpoint=None):
    conf = SimpleNamespace(get=lambda key, default=None: settings.get(key, default))
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(
        getCheckpointDir=lambda: checkpoint))


def test_the_cluster_names_the_folder():
    assert session.shared_folder(fake({"spark.checkpoint.dir": "hdfs:///shared/"})) == \
        "hdfs:///shared"
    assert session.shared_folder(fake({}, "hdfs:///set/")) == "hdfs:///set"


def test_a_session_without_a_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_folder(fake({}))


PLAIN = """
import sys
sys.path.insert(0, {root!r})
from tradewake.session import build_session, clear_scratch, stored
spark = build_session("plain", "local[2]", **{{"spark.ui.enabled": "false"}})
assert spark.conf.get("spark.checkpoint.dir", None) is None
try:
    stored(spark.range(3), "refused")
except RuntimeError as error:
    assert "spark.checkpoint.dir" in str(error)
else:
    raise SystemExit("a folder was made up")
spark.sparkContext.setCheckpointDir({folder!r})
assert stored(spark.range(3), "kept").count() == 3
assert clear_scratch(spark) == 1
print("DONE")
"""


def test_a_real_session_without_defaults(tmp_path):
    (tmp_path / "conf").mkdir()
    code = PLAIN.format(root=str(Path(session.__file__).parents[1]), folder=str(tmp_path / "shared"))
    ran = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=180,
                         env={**os.environ, "SPARK_CONF_DIR": str(tmp_path / "conf")})
    assert "DONE" in ran.stdout, ran.stderr[-2000:]
    assert not list((tmp_path / "shared").rglob("*.parquet"))


def test_scratch_of_a_job_is_deleted(spark, monkeypatch):
    monkeypatch.setattr(session, "_scratch", [])
    frame = session.stored(spark.range(3), "gone")
    path = session._scratch[0]
    assert files.exists(spark, path) and frame.count() == 3
    assert session.clear_scratch(spark) == 1 and not files.exists(spark, path)


def test_stored_frame_is_read_back_with_its_schema(spark):
    frame = spark.range(3).selectExpr("id", "cast(id as string) as s", "current_date() as d")
    again = session.stored(frame, "test")
    assert again.schema.simpleString() == frame.schema.simpleString()
    assert again.count() == 3 and len(again.inputFiles()) >= 1
