"""A message topic of many writers, as a streaming data source and sink.

Below the topic's folder every writer has a shard of its own: message files in
``shards/<writer>`` and one list per epoch in ``commits/<writer>``. Tasks write files under fresh
names; they count once the epoch's list names them, and a list is put in place as a whole
and never replaced. So an epoch that runs again after a failure publishes nothing new, and a
reader sees all of an epoch or nothing, whoever else writes at the time.

A reader's offset says for every shard how far it has read: the epoch and how many of its
files. ``rows_per_batch`` limits what one micro-batch admits, in whole files, shards in
turn; a large file is read by several tasks, by row groups. Only lists of files pass the
driver. The folder may be anywhere that Arrow's file systems reach (a shared folder, HDFS,
object stores).
"""

from __future__ import annotations

import json
import posixpath
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamArrowWriter,
    DataSourceStreamReader, InputPartition, WriterCommitMessage,
)
from pyspark.sql.types import StructType

FORMAT = "message_log"
MESSAGE_SCHEMA = (
    "data binary, attributes map<string,string>, message_id string, publish_time timestamp"
)
ARROW_SCHEMA = pa.schema([
    ("data", pa.binary()), ("attributes", pa.map_(pa.string(), pa.string())),
    ("message_id", pa.string()), ("publish_time", pa.timestamp("us", "UTC"))])
GROUP_ROWS = 1 << 16
#: Rows of a reading task, in whole row groups.
TASK_ROWS = 1 << 18


class Log:
    """The files of one topic."""

    def __init__(self, place: str):
        self.place = place
        self.files, self.root = (
            fs.FileSystem.from_uri(place) if "://" in place or place.startswith("file:")
            else (fs.LocalFileSystem(), place))

    def path(self, *parts: str) -> str:
        return posixpath.join(self.root, *parts)

    def names(self, *parts: str) -> list[str]:
        found = self.files.get_file_info(
            fs.FileSelector(self.path(*parts), allow_not_found=True))
        return sorted(f.base_name for f in found)

    def writers(self) -> list[str]:
        return self.names("commits")

    def epochs(self, writer: str) -> list[int]:
        return [int(n[:-5]) for n in self.names("commits", writer) if n.endswith(".json")]

    def _list(self, writer: str, epoch: int) -> str:
        return self.path("commits", writer, f"{epoch:019d}.json")

    def committed(self, writer: str, epoch: int) -> list[list]:
        """``[name, rows, row groups]`` of the files of an epoch."""
        with self.files.open_input_stream(self._list(writer, epoch)) as f:
            return json.loads(f.read())

    def has(self, writer: str, epoch: int) -> bool:
        return self.files.get_file_info(self._list(writer, epoch)).type != fs.FileType.NotFound

    def commit(self, writer: str, epoch: int, files: list[list]) -> bool:
        """Publish the files as an epoch, unless it has been published before."""
        if self.has(writer, epoch):
            return False
        self.files.create_dir(self.path("commits", writer))
        fresh = self.path("commits", writer, f".{uuid.uuid4().hex}")
        with self.files.open_output_stream(fresh) as f:
            f.write(json.dumps(files).encode())
        self.files.move(fresh, self._list(writer, epoch))
        return True

    def write(self, writer: str, batches: Iterator[pa.RecordBatch], id_label: str | None = None
              ) -> list | None:
        """A file of the messages that is not published yet. Messages without an id get
        one from the name of the file and their place in it, with ``id_label`` also as that
        attribute."""
        out = MessageFile(self, writer, id_label)
        try:
            for batch in batches:
                out.add(pa.Table.from_batches([batch]))
        finally:
            done = out.close()
        return done

    def remove(self, writer: str, names: list[str]) -> None:
        for name in names:
            self.files.delete_file(self.path("shards", writer, name))


class MessageFile:
    """A file of messages of a shard, made with the first message."""

    def __init__(self, log: Log, writer: str, id_label: str | None = None):
        self.log, self.writer, self.id_label = log, writer, id_label
        self.name, self.rows, self.out = f"{uuid.uuid4().hex}.parquet", 0, None

    @property
    def path(self) -> str:
        return self.log.path("shards", self.writer, self.name)

    def add(self, messages: pa.Table) -> None:
        if not messages.num_rows:
            return
        if self.out is None:
            self.log.files.create_dir(self.log.path("shards", self.writer))
            self.out = pq.ParquetWriter(self.path, ARROW_SCHEMA, filesystem=self.log.files)
        table = messages.select(ARROW_SCHEMA.names).cast(ARROW_SCHEMA)
        if table["message_id"].null_count:
            table = with_ids(table, f"{self.name[:32]}-", self.rows, self.id_label)
        self.out.write_table(table, row_group_size=GROUP_ROWS)
        self.rows += len(table)

    def close(self) -> list | None:
        """Name, rows and row groups; nothing without messages."""
        if self.out is None:
            return None
        self.out.close()
        groups = pq.ParquetFile(self.path, filesystem=self.log.files).num_row_groups
        return [self.name, self.rows, groups]


def with_ids(table: pa.Table, prefix: str, first: int, id_label: str | None) -> pa.Table:
    """Messages without an id get ``prefix`` and their number."""
    ids = pa.array([f"{prefix}{i}" for i in range(first, first + len(table))])
    missing = pc.is_null(table["message_id"]).to_pylist()
    if id_label:
        labelled = [[*(pairs or []), (id_label, i)] if lost else pairs for pairs, i, lost in zip(
            table["attributes"].to_pylist(), ids.to_pylist(), missing, strict=True)]
        table = table.set_column(1, "attributes", pa.array(labelled, ARROW_SCHEMA[1].type))
    return table.set_column(2, "message_id", pc.coalesce(table["message_id"], ids))


@dataclass
class Slice(InputPartition):
    """Row groups ``first`` to ``last - 1`` of a message file."""

    writer: str
    name: str
    first: int
    last: int


def slices(writer: str, files: list[list]) -> list[Slice]:
    out = []
    for name, rows, groups in files:
        step = max(1, TASK_ROWS * groups // max(rows, 1))
        out += [Slice(writer, name, g, min(g + step, groups)) for g in range(0, groups, step)]
    return out


def read_slice(place: str, part: Slice) -> Iterator[pa.RecordBatch]:
    log = Log(place)
    with log.files.open_input_file(log.path("shards", part.writer, part.name)) as f:
        yield from pq.ParquetFile(f).iter_batches(
            row_groups=list(range(part.first, part.last)), columns=ARROW_SCHEMA.names)


class TableReader(DataSourceReader):
    """All messages published so far."""

    def __init__(self, place: str):
        self.place = place

    def partitions(self) -> list[InputPartition]:
        log = Log(self.place)
        found = [s for w in log.writers() for e in log.epochs(w)
                 for s in slices(w, log.committed(w, e))]
        return found or [Slice("", "", 0, 0)]

    def read(self, partition: Slice) -> Iterator[pa.RecordBatch]:
        if partition.name:
            yield from read_slice(self.place, partition)


class StreamReader(DataSourceStreamReader):
    """Offsets are ``{shard: [epoch, files]}``: all before that epoch and so many of its
    files have been read. A query that goes on from a checkpoint first plans the last batch of
    its log, which tells where it stands; one that asks for offsets before is at the start."""

    def __init__(self, place: str, rows_per_batch: int | None):
        self.place, self.limit = place, rows_per_batch
        self.position: dict = {}

    def initialOffset(self) -> dict:
        return {}

    def _ahead(self, log: Log, position: dict, writer: str) -> Iterator[tuple[int, int, list]]:
        """Epoch, place in it and file of what has not been read of a shard."""
        epoch, done = position.get(writer, (-1, 0))
        for e in log.epochs(writer):
            if e >= epoch:
                for i, file in enumerate(log.committed(writer, e)):
                    if e > epoch or i >= done:
                        yield e, i, file

    def latestOffset(self) -> dict:
        log = Log(self.place)
        position = dict(self.position)
        room = float("inf") if self.limit is None else self.limit
        ahead = {w: self._ahead(log, position, w) for w in log.writers()}
        while ahead and room > 0:
            for writer in list(ahead):
                step = next(ahead[writer], None)
                if step is None:
                    del ahead[writer]
                elif room > 0:
                    position[writer] = [step[0], step[1] + 1]
                    room -= step[2][1]
        self.position = dict(sorted(position.items()))
        return self.position

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        self.position = {w: max(end.get(w, []), self.position.get(w, []))
                         for w in sorted({*end, *self.position})}
        log, out = Log(self.place), []
        for writer, (epoch, done) in end.items():
            for e, i, file in self._ahead(log, start, writer):
                if (e, i) >= (epoch, done):
                    break
                out += slices(writer, [file])
        return out or [Slice("", "", 0, 0)]

    def read(self, partition: Slice) -> Iterator[pa.RecordBatch]:
        if partition.name:
            yield from read_slice(self.place, partition)


@dataclass
class Written(WriterCommitMessage):
    file: list | None


class _Writer:
    def __init__(self, place: str, writer: str, id_label: str | None):
        self.place, self.name, self.id_label = place, writer, id_label

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        return Written(Log(self.place).write(self.name, iterator, self.id_label))

    def _publish(self, messages: list, epoch: int) -> None:
        files = [m.file for m in messages if m and m.file]
        log = Log(self.place)
        if files and not log.commit(self.name, epoch, files):
            log.remove(self.name, [f[0] for f in files])

    def _forget(self, messages: list) -> None:
        Log(self.place).remove(self.name, [m.file[0] for m in messages if m and m.file])


class StreamWriter(_Writer, DataSourceStreamArrowWriter):
    """One epoch of a shard per micro-batch."""

    def commit(self, messages: list, batchId: int) -> None:
        self._publish(messages, batchId)

    def abort(self, messages: list, batchId: int) -> None:
        self._forget(messages)


class TableWriter(_Writer, DataSourceArrowWriter):
    """The next epoch of a shard; those who write tables to one shard take turns."""

    def commit(self, messages: list) -> None:
        self._publish(messages, max(Log(self.place).epochs(self.name), default=-1) + 1)

    def abort(self, messages: list) -> None:
        self._forget(messages)


class MessageLog(DataSource):
    """Options: ``path``; to read ``rows_per_batch``; to write ``writer``, the name of the shard,
    and ``id_label``, an attribute for the ids that messages get here."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return MESSAGE_SCHEMA

    def _writer(self) -> str:
        name = self.options.get("writer") or uuid.uuid4().hex
        if not re.fullmatch(r"\w[\w.-]*", name):
            raise ValueError(f"not a name of a shard: {name!r}")
        return name

    def reader(self, schema: StructType) -> TableReader:
        return TableReader(self.options["path"])

    def streamReader(self, schema: StructType) -> StreamReader:
        limit = self.options.get("rows_per_batch")
        return StreamReader(self.options["path"], int(limit) if limit else None)

    def writer(self, schema: StructType, overwrite: bool) -> TableWriter:
        if overwrite:
            raise ValueError("messages can only be appended to a topic")
        return TableWriter(self.options["path"], self._writer(), self.options.get("id_label"))

    def streamWriter(self, schema: StructType, overwrite: bool) -> StreamWriter:
        return StreamWriter(self.options["path"], self._writer(), self.options.get("id_label"))
