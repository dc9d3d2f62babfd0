"""Several topics from one stream in one pass: every row goes to the topic of its tag.

The topics are logs (``sources/topic_log.py``) below one folder. A micro-batch is one
transaction: its tasks write the files of all topics, then one list that names them all is put
in place and never replaced, and then each topic publishes what that list says. A batch that runs
again after a failure at any point finishes the transaction of its first run, and what it wrote
itself is removed; so no topic gets a row twice, and no two topics show different runs of a batch.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..sources.topic_log import MESSAGE_SCHEMA, Log, MessageFile
from ..sources.topics import to_messages
from ..streaming.runner import start

FORMAT = "tagged_message_logs"
TRANSACTIONS = "_transactions"


@dataclass
class TaggedFiles(WriterCommitMessage):
    """``[tag, name, rows, row groups]`` of the files of a task."""

    files: list


class TaggedWriter(DataSourceStreamArrowWriter):
    def __init__(self, place: str, writer: str, tags: list[str], id_label: str | None):
        self.place, self.name, self.tags, self.id_label = place, writer, tags, id_label

    def _log(self, tag: str) -> Log:
        return Log(f"{self.place}/{tag}")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> TaggedFiles:
        outs: dict[str, MessageFile] = {}
        try:
            for batch in iterator:
                table = pa.Table.from_batches([batch])
                for tag in pc.unique(table["tag"]).to_pylist():
                    if tag not in self.tags:
                        raise ValueError(f"no topic for the tag {tag!r}")
                    if tag not in outs:
                        outs[tag] = MessageFile(self._log(tag), self.name, self.id_label)
                    outs[tag].add(table.filter(pc.equal(table["tag"], tag)))
        finally:
            done = {tag: out.close() for tag, out in outs.items()}
        return TaggedFiles([[tag, *file] for tag, file in done.items() if file])

    def commit(self, messages: list, batchId: int) -> None:
        files = [f for m in messages if m for f in m.files]
        transactions = Log(f"{self.place}/{TRANSACTIONS}")
        if not transactions.commit(self.name, batchId, files):
            self._remove(files)
            files = transactions.committed(self.name, batchId)
        for tag in self.tags:
            own = [f[1:] for f in files if f[0] == tag]
            if own:
                self._log(tag).commit(self.name, batchId, own)

    def abort(self, messages: list, batchId: int) -> None:
        # once the list of a transaction is in place, its files are no longer this run's
        transactions, kept = Log(f"{self.place}/{TRANSACTIONS}"), []
        if transactions.has(self.name, batchId):
            kept = transactions.committed(self.name, batchId)
        self._remove([f for m in messages if m for f in m.files if f not in kept])

    def _remove(self, files: list) -> None:
        for tag, name, *_ in files:
            self._log(tag).remove(self.name, [name])


class TaggedLogs(DataSource):
    """Options: ``path``; ``writer``, the name of the shard; ``tags``, a JSON list; ``id_label``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return f"tag string, {MESSAGE_SCHEMA}"

    def streamWriter(self, schema: StructType, overwrite: bool) -> TaggedWriter:
        return TaggedWriter(self.options["path"].rstrip("/"), self.options["writer"],
                            json.loads(self.options["tags"]), self.options.get("id_label"))


def write_tagged_messages(
    df: DataFrame,
    place: str,
    checkpoint: str,
    tags: Sequence[str],
    *,
    tag: str = "tag",
    data: Column | None = None,
    message_id: Column | None = None,
    id_label: str | None = None,
    timestamp_attribute: str | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Start a stream into the topics ``log:place/<tag>``, one for each of ``tags``, which must
    be names of folders. A row with another tag, or none, stops the stream."""
    for name in tags:
        if not name or name.startswith(("_", ".")) or "/" in name:
            raise ValueError(f"not a name of a topic: {name!r}")
    # the tag travels as an attribute of its own name and is taken off again
    carried = to_messages(
        df, F.col("data") if data is None else data, attributes={"": F.col(tag)},
        message_id=message_id, content_ids=False, id_label=id_label,
        timestamp_attribute=timestamp_attribute)
    messages = carried.select(
        F.col("attributes")[""].alias("tag"), "data",
        F.map_filter("attributes", lambda k, _: k != "").alias("attributes"),
        "message_id", "publish_time")
    df.sparkSession.dataSource.register(TaggedLogs)
    shard = hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:16]
    writer = messages.writeStream.format(FORMAT).outputMode("append").options(
        path=place, writer=shard, tags=json.dumps(list(tags)), checkpointLocation=checkpoint,
        **({"id_label": id_label} if id_label else {}))
    return start(writer.trigger(availableNow=True) if available_now else writer, df)
