"""A streaming sink to a message bus that publishes a batch once.

Tasks stage their messages on the bus, where nobody sees them; when all have, the driver commits the
batch with the tokens of what they staged. A commit is keyed by the batch's number, so a batch that
is run again after its commit publishes nothing more, and one that failed half-way has left nothing
behind but staged messages, which are aborted.
"""

from __future__ import annotations

import base64
import itertools
import json
import time
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from typing import Protocol

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamWriter, WriterCommitMessage
from pyspark.sql.streaming import DataStreamWriter

#: Messages that are staged at a time.
BLOCK = 1000


class Bus(Protocol):
    """What a bus must do; stage runs in tasks, the others in the driver. A ConnectionError is tried again."""

    def stage(self, messages: list[tuple[str, str]]) -> str:
        """Hold messages (subject, payload) back; a token for them."""

    def commit(self, batch: int, tokens: list[str]) -> None:
        """Publish what is staged, unless the batch is published already."""

    def abort(self, batch: int | None, tokens: list[str]) -> None:
        """Drop what is staged, but for what the batch has published: a commit may be done and still seem to fail."""


@dataclass
class Staged(WriterCommitMessage):
    tokens: list[str]


class BusWriter(DataSourceStreamWriter):
    def __init__(self, bus: Bus, attempts: int, pause: float):
        self.bus, self.attempts, self.pause = bus, attempts, pause

    def _again(self, work):
        for attempt in itertools.count(1):
            try:
                return work()
            except ConnectionError:
                if attempt >= self.attempts:
                    raise
                time.sleep(self.pause)
                if hasattr(self.bus, "reconnect"):
                    self.bus.reconnect()

    def write(self, iterator: Iterator) -> Staged:
        tokens: list[str] = []
        try:
            while block := [(r["subject"], r["payload"]) for r in itertools.islice(iterator, BLOCK)]:
                tokens.append(self._again(lambda block=block: self.bus.stage(block)))
        except Exception:
            self.bus.abort(None, tokens)
            raise
        return Staged(tokens)

    def _tokens(self, messages: Iterable[Staged | None]) -> list[str]:
        return [t for m in messages if m is not None for t in m.tokens]

    def commit(self, messages: list[Staged | None], batchId: int) -> None:  # noqa: N803
        self._again(lambda: self.bus.commit(batchId, self._tokens(messages)))

    def abort(self, messages: list[Staged | None], batchId: int) -> None:  # noqa: N803
        self.bus.abort(batchId, self._tokens(messages))


class BusSink(DataSource):
    @classmethod
    def name(cls) -> str:
        return "message_bus"

    def schema(self) -> str:
        return "subject string, payload string"

    def streamWriter(self, schema, overwrite: bool) -> BusWriter:  # noqa: N802
        return BusWriter(*cloudpickle.loads(base64.b64decode(self.options["bus"])))


def to_bus(messages: DataFrame, bus: Bus, checkpoint: str, attempts: int = 3, pause: float = 1.0) -> DataStreamWriter:
    """A writer of a streaming frame of subject and payload; start() it with a trigger of one's own."""
    spark: SparkSession = messages.sparkSession
    spark.dataSource.register(BusSink)
    packed = base64.b64encode(cloudpickle.dumps((bus, attempts, pause))).decode()
    return messages.select("subject", "payload").writeStream.format("message_bus").option("bus", packed).option("checkpointLocation", checkpoint)


@dataclass(frozen=True)
class FolderBus:
    """A bus in a shared folder: staged messages are files, a published batch is a list of their names."""

    folder: str

    def _fs(self):
        from pyarrow import fs

        found, path = fs.FileSystem.from_uri(self.folder if "://" in self.folder or self.folder.startswith("file:") else f"file://{self.folder}")
        for part in ("staged", "batches"):
            found.create_dir(f"{path}/{part}", recursive=True)
        return found, path

    def stage(self, messages: list[tuple[str, str]]) -> str:
        found, path = self._fs()
        token = uuid.uuid4().hex
        with found.open_output_stream(f"{path}/staged/{token}") as f:
            f.write(json.dumps(messages).encode())
        return token

    def commit(self, batch: int, tokens: list[str]) -> None:
        from pyarrow import fs

        found, path = self._fs()
        target = f"{path}/batches/{batch:020d}"
        if found.get_file_info(target).type != fs.FileType.NotFound:
            return self.abort(batch, tokens)
        # The list appears as a whole or not at all.
        name = f"{path}/staged/{uuid.uuid4().hex}.list"
        with found.open_output_stream(name) as f:
            f.write(json.dumps(tokens).encode())
        found.move(name, target)

    def abort(self, batch: int | None, tokens: list[str]) -> None:
        from pyarrow import fs

        found, path = self._fs()
        target = f"{path}/batches/{batch or 0:020d}"
        published: set[str] = set()
        if batch is not None and found.get_file_info(target).type != fs.FileType.NotFound:
            published = set(json.loads(found.open_input_stream(target).read()))
        for t in set(tokens) - published:
            if found.get_file_info(f"{path}/staged/{t}").type != fs.FileType.NotFound:
                found.delete_file(f"{path}/staged/{t}")

    def messages(self) -> list[tuple[int, str, str]]:
        """(batch, subject, payload) of what is published, in order of batches."""
        from pyarrow import fs

        found, path = self._fs()
        read = lambda p: json.loads(found.open_input_stream(p).read())
        lists = sorted(i.path for i in found.get_file_info(fs.FileSelector(f"{path}/batches")))
        return [(int(p.rpartition("/")[2]), subject, payload) for p in lists for t in read(p) for subject, payload in read(f"{path}/staged/{t}")]
