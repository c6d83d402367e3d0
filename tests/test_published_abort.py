"""A failed write takes away what its stopped tasks left, and nothing else."""

import os
import threading

from pyspark.sql.types import LongType, StructField, StructType

from modeloom.sources import published
from modeloom.sources.published import FolderWriter

SCHEMA = StructType([StructField("id", LongType())])


def test_files_no_message_names_go_with_their_write(tmp_path, monkeypatch):
    monkeypatch.setattr(published, "ENDING", 0.0)
    failed, other = (FolderWriter(str(tmp_path), SCHEMA, True) for _ in range(2))
    kept = ["_manifest.json", "part-0123.parquet", f"{other.begin}1.parquet"]
    for name in [*kept, f"{failed.begin}1.parquet", f"{failed.begin}2.parquet"]:
        (tmp_path / name).write_text("")
    failed.abort([None, None])
    assert sorted(os.listdir(tmp_path)) == sorted(kept)
    FolderWriter(str(tmp_path / "none"), SCHEMA, True).abort([None])
    assert not (tmp_path / "none").exists()


def test_files_of_tasks_that_are_still_being_stopped_go_too(tmp_path):
    failed = FolderWriter(str(tmp_path), SCHEMA, True)
    late = threading.Timer(0.6, (tmp_path / f"{failed.begin}late.parquet").write_text, [""])
    late.start()
    failed.abort([None])
    late.join()
    assert os.listdir(tmp_path) == []
