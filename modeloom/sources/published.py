"""A connector for published folders: parquet files that one manifest lists.

``register(spark)`` makes it known as format ``published``.  Readers see the files of the
manifest only.  A write's tasks add files of their own; the manifest is replaced once, after
all tasks have ended, so a write that fails or is killed changes nothing, and a write that
fails takes its files away.  The files of the version before stay for its readers until the
next write.  One writer at a time; the folder must be one that Arrow's file systems can open.

Comparisons with values that are not floating point are pushed to the source: row groups they
rule out are not read, and the rest are filtered there.  All other filters stay with Spark.
"""

from __future__ import annotations

import contextlib
import json
import re
import time
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from datetime import date

import pyarrow as pa
import pyarrow.dataset as ds
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    LessThan,
    LessThanOrEqual,
    WriterCommitMessage,
)
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

FORMAT = "published"
MANIFEST = "_manifest.json"
# Bytes of one file at most before its row groups are dealt to several tasks.
SPLIT_BYTES = 128 << 20
EXACT = (bool, int, str, date)
# Seconds for which a failed write looks for files: its other tasks are still being stopped then,
# and Spark gives their workers two.
ENDING = 3.0


def register(spark: SparkSession) -> None:
    """Make the format known to the session, and let it take filters."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(PublishedFolder)


def _opened(folder: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder, given as a path or a URI."""
    local = re.sub(r"^file:/+", "/", folder)
    if "://" in local:
        return fs.FileSystem.from_uri(local)
    return fs.LocalFileSystem(), local


def _manifest(folder: str) -> dict | None:
    """What is published, or None."""
    system, path = _opened(folder)
    if system.get_file_info(f"{path}/{MANIFEST}").type == fs.FileType.NotFound:
        return None
    with system.open_input_stream(f"{path}/{MANIFEST}") as stream:
        return json.loads(stream.read())


def _delete(folder: str, names: Iterable[str]) -> None:
    system, path = _opened(folder)
    for name in names:
        if system.get_file_info(f"{path}/{name}").type != fs.FileType.NotFound:
            # a task that was stopped may be taking its own file away
            with contextlib.suppress(FileNotFoundError):
                system.delete_file(f"{path}/{name}")


class PublishedFolder(DataSource):
    """Options: ``path``, or ``table`` as the readers and writers of this package pass it."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    @property
    def folder(self) -> str:
        return (self.options.get("path") or self.options["table"]).rstrip("/")

    def schema(self) -> StructType:
        found = _manifest(self.folder)
        if found is None:
            raise FileNotFoundError(f"nothing is published in {self.folder}")
        return StructType.fromJson(found["schema"])

    def reader(self, schema: StructType) -> FolderReader:
        return FolderReader(self.folder, schema)

    def writer(self, schema: StructType, overwrite: bool) -> FolderWriter:
        return FolderWriter(self.folder, schema, overwrite)


@dataclass
class RowGroups(InputPartition):
    """Some row groups of one file."""

    file: str
    groups: list[int]


def _expression(wanted: Filter) -> ds.Expression | None:
    """The filter for Arrow, or None where it may mean something else there."""
    if len(getattr(wanted, "attribute", ())) != 1:
        return None
    field = ds.field(wanted.attribute[0])
    if isinstance(wanted, IsNull):
        return field.is_null()
    if isinstance(wanted, IsNotNull):
        return field.is_valid()
    if isinstance(wanted, In):
        # NULL among the values makes no row true
        values = [v for v in wanted.value if v is not None]
        return field.isin(values) if all(type(v) in EXACT for v in values) else None
    if type(getattr(wanted, "value", None)) not in EXACT:
        return None
    value = wanted.value
    if isinstance(wanted, EqualTo):
        return field == value
    if isinstance(wanted, GreaterThan):
        return field > value
    if isinstance(wanted, GreaterThanOrEqual):
        return field >= value
    if isinstance(wanted, LessThan):
        return field < value
    if isinstance(wanted, LessThanOrEqual):
        return field <= value
    return None


class FolderReader(DataSourceReader):
    def __init__(self, folder: str, schema: StructType):
        self.folder, self.schema = folder, schema
        self.pushed: list[Filter] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for wanted in filters:
            if _expression(wanted) is None:
                yield wanted
            else:
                self.pushed.append(wanted)

    def _filter(self) -> ds.Expression | None:
        whole = None
        for wanted in self.pushed:
            one = _expression(wanted)
            whole = one if whole is None else whole & one
        return whole

    def partitions(self) -> list[RowGroups]:
        # the manifest holds the groups' sizes, so that no file is opened here
        out = []
        for file in (_manifest(self.folder) or {"files": []})["files"]:
            held, size = [], 0
            for group, taken in enumerate(file["group_bytes"]):
                held.append(group)
                size += taken
                if size >= SPLIT_BYTES:
                    out.append(RowGroups(file["name"], held))
                    held, size = [], 0
            if held:
                out.append(RowGroups(file["name"], held))
        # Spark wants one partition at least
        return out or [RowGroups("", [])]

    def read(self, partition: RowGroups) -> Iterator[pa.RecordBatch]:
        if not partition.groups:
            return
        system, path = _opened(self.folder)
        form = ds.ParquetFileFormat()
        fragment = form.make_fragment(
            f"{path}/{partition.file}", system, row_groups=partition.groups
        )
        names = self.schema.fieldNames()
        for batch in fragment.to_batches(columns=names, filter=self._filter()):
            if batch.num_rows:
                yield batch


@dataclass
class Written(WriterCommitMessage):
    """A task's file, if it had rows, and the bytes of its row groups."""

    name: str | None
    group_bytes: list[int]


class FolderWriter(DataSourceArrowWriter):
    def __init__(self, folder: str, schema: StructType, overwrite: bool):
        self.folder, self.schema, self.overwrite = folder, schema, overwrite
        # all files of one write begin alike, so that it finds those of tasks that were stopped
        self.begin = f"part-{uuid.uuid4().hex[:8]}-"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, path = _opened(self.folder)
        name, writer = f"{self.begin}{uuid.uuid4().hex}.parquet", None
        try:
            for batch in iterator:
                if batch.num_rows == 0:
                    continue
                if writer is None:
                    system.create_dir(path, recursive=True)
                    wanted = to_arrow_schema(self.schema)
                    stream = system.open_output_stream(f"{path}/{name}")
                    writer = pq.ParquetWriter(stream, wanted, compression="zstd")
                columns = [c.cast(f.type) for c, f in zip(batch.columns, wanted, strict=True)]
                writer.write_batch(pa.RecordBatch.from_arrays(columns, schema=wanted))
            if writer is None:
                return Written(None, [])
            writer.close()
            stream.close()
        except BaseException:
            if writer is not None:
                stream.close()
                _delete(self.folder, [name])
            raise
        with system.open_input_file(f"{path}/{name}") as source:
            held = pq.ParquetFile(source).metadata
        return Written(
            name, [held.row_group(g).total_byte_size for g in range(held.num_row_groups)]
        )

    def commit(self, messages: list[Written | None]) -> None:
        system, path = _opened(self.folder)
        before = _manifest(self.folder) or {"files": [], "previous": []}
        new = [
            {"name": m.name, "group_bytes": m.group_bytes} for m in messages if m and m.name
        ]
        held = {
            "schema": self.schema.jsonValue(),
            "files": new if self.overwrite else before["files"] + new,
            "previous": [f["name"] for f in before["files"]] if self.overwrite else [],
        }
        system.create_dir(path, recursive=True)
        fresh = f"{path}/{MANIFEST}.{uuid.uuid4().hex}"
        with system.open_output_stream(fresh) as stream:
            stream.write(json.dumps(held).encode())
        system.move(fresh, f"{path}/{MANIFEST}")
        # what no reader of this version or the one before sees
        _delete(self.folder, before["previous"])

    def abort(self, messages: list[Written | None]) -> None:
        system, path = _opened(self.folder)
        until = time.monotonic() + ENDING
        while True:
            found = system.get_file_info(fs.FileSelector(path, allow_not_found=True))
            _delete(self.folder, [f.base_name for f in found if f.base_name.startswith(self.begin)])
            if time.monotonic() >= until:
                return
            time.sleep(0.25)
