"""Key -> document files as a Spark data source: whole or not at all.

Every task writes a file of its own in a pending folder of the job. Only when all tasks have succeeded does the driver
move the files beside the committed ones and replace the list of committed files in one step; a failed job deletes its
pending folder (a task that is still being stopped may leave a file there, which nobody looks at). Readers follow the list, so they see all documents of a job or none.
"""

import json
import uuid
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

FORMAT, LISTED = "keyed_documents", "_committed.json"


def _store(path):
    """(filesystem, folder) of a path or URI; whatever store the workers of a cluster share."""
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path)


def _committed(store, folder):
    target = f"{folder}/{LISTED}"
    if store.get_file_info(target).type == fs.FileType.NotFound:
        return []
    with store.open_input_stream(target) as source:
        return json.loads(source.read())


@dataclass
class TaskFile(WriterCommitMessage):
    name: str
    documents: int


class DocumentWriter(DataSourceWriter):
    def __init__(self, path, overwrite):
        self.path, self.overwrite, self.job = path, overwrite, uuid.uuid4().hex

    def _pending(self, folder):
        return f"{folder}/_pending-{self.job}"

    def write(self, rows):
        store, folder = _store(self.path)
        store.create_dir(self._pending(folder), recursive=True)
        name, documents = f"{uuid.uuid4().hex}.jsonl", 0
        with store.open_output_stream(f"{self._pending(folder)}/{name}") as out:
            for row in rows:
                out.write((json.dumps([row["key"], row["value"]], ensure_ascii=False) + "\n").encode())
                documents += 1
        return TaskFile(name, documents)

    def commit(self, messages):
        store, folder = _store(self.path)
        before, new = _committed(store, folder), [m.name for m in messages if m is not None and m.documents]
        for name in new:
            store.move(f"{self._pending(folder)}/{name}", f"{folder}/{name}")
        store.create_dir(folder, recursive=True)
        with store.open_output_stream(f"{folder}/{LISTED}.{self.job}") as out:
            out.write(json.dumps(new if self.overwrite else before + new).encode())
        store.move(f"{folder}/{LISTED}.{self.job}", f"{folder}/{LISTED}")
        self._drop(store, self._pending(folder))
        for name in before if self.overwrite else []:
            store.delete_file(f"{folder}/{name}")

    def abort(self, messages):
        store, folder = _store(self.path)
        self._drop(store, self._pending(folder))

    @staticmethod
    def _drop(store, folder):
        if store.get_file_info(folder).type != fs.FileType.NotFound:
            store.delete_dir(folder)


class DocumentReader(DataSourceReader):
    def __init__(self, path):
        self.path = path

    def partitions(self):
        return [InputPartition(name) for name in _committed(*_store(self.path))]

    def read(self, partition):
        if partition is None or partition.value is None:
            return
        store, folder = _store(self.path)
        with store.open_input_stream(f"{folder}/{partition.value}") as source:
            rest = b""
            while chunk := source.read(1 << 20):
                *lines, rest = (rest + chunk).split(b"\n")
                for line in lines:
                    yield tuple(json.loads(line))


class KeyedDocuments(DataSource):
    """Options: ``path``."""

    @classmethod
    def name(cls):
        return FORMAT

    def schema(self):
        return "key string, value string"

    def writer(self, schema, overwrite):
        return DocumentWriter(self.options["path"], overwrite)

    def reader(self, schema):
        return DocumentReader(self.options["path"])


def write(docs, path, mode="overwrite"):
    """Writes (key, value) documents; a task that fails leaves nothing that a reader sees."""
    docs.sparkSession.dataSource.register(KeyedDocuments)
    docs.select("key", "value").write.format(FORMAT).option("path", path).mode(mode).save()


def read(spark, path):
    """The committed documents; none where no job has finished."""
    spark.dataSource.register(KeyedDocuments)
    return spark.read.format(FORMAT).option("path", path).load()
