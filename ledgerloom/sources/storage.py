"""Data sources over files that stand in shared storage: hashed files, objects under the address of their content, JSON packs.

Files are opened by their URI (``file``, and what else pyarrow's file systems know), by
any executor, and read and written in pieces. A reader's partitions are files, a large
one alone; a folder is listed once, by the driver, as Spark's own file sources do.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import uuid
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as files
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from ledgerloom.functions.scalars import object_path
from ledgerloom.sources.jsonstream import JsonError, pieces, unzipped

#: Bytes read at once; bytes of files that one task reads; the most bytes of an object.
STEP, TASK_BYTES, OBJECT_BYTES = 1 << 20, 128 << 20, 128 << 20
#: Folders of an object store that one task reads.
TASK_FOLDERS = 4


def opened(uri: str) -> tuple[files.FileSystem, str]:
    """A file system and the path in it."""
    uri = re.sub(r"^file:/+", "/", uri)
    return (files.LocalFileSystem(), uri) if uri.startswith("/") else files.FileSystem.from_uri(uri)


def listed(root: str, keep: Callable[[str], bool] = lambda name: True) -> list[tuple[str, int]]:
    """(path, bytes) of the files below a folder, or of the one file, in order of paths; names that begin with ``_`` or ``.`` are
    left out, as in Spark's file sources, and a link in a local folder is an error."""
    fs, path = opened(root)
    info = fs.get_file_info(path)
    if info.type == files.FileType.NotFound:
        raise FileNotFoundError(root)
    if info.is_file:
        return [(path, info.size)]
    return [f for f in below(fs, path) if keep(f[0].rsplit("/", 1)[-1])]


def hidden(name: str) -> bool:
    return name[:1] in "_."


def unlinked(fs: files.FileSystem, folder: str, found: list[files.FileInfo]) -> None:
    if isinstance(fs, files.LocalFileSystem) and any(os.path.islink(f.path) for f in found):
        raise ValueError(f"{folder} holds a link")


def below(fs: files.FileSystem, folder: str) -> list[tuple[str, int]]:
    base = folder.rstrip("/")
    found = [f for f in fs.get_file_info(files.FileSelector(folder, recursive=True)) if not any(map(hidden, f.path[len(base) + 1 :].split("/")))]
    unlinked(fs, folder, found)
    return sorted((f.path, f.size) for f in found if f.is_file)


def top(root: str) -> tuple[list[str], list[tuple[str, int]]]:
    """The folders in a folder, and the files beside them, as ``listed`` would find what is in them."""
    fs, path = opened(root)
    found = [f for f in fs.get_file_info(files.FileSelector(path)) if not hidden(f.base_name)]
    unlinked(fs, root, found)
    return sorted(f.path for f in found if not f.is_file), sorted((f.path, f.size) for f in found if f.is_file)


@dataclass
class Folders(InputPartition):
    paths: list[str]


@dataclass
class Files(InputPartition):
    paths: list[str]


def dealt(found: list[tuple[str, int]]) -> list[InputPartition]:
    """Neighbouring files together up to ``TASK_BYTES``."""
    out: list[InputPartition] = []
    total = 0
    for path, size in found:
        if not out or total + size > TASK_BYTES:
            out.append(Files([]))
            total = 0
        out[-1].paths.append(path)
        total += size
    return out


class Measure:
    """Bytes and digest of content as it stands and, where it is gzip, bytes once decoded; a piece at a time."""

    def __init__(self):
        self.bytes, self.sha, self.decoded, self.members = 0, hashlib.sha256(), 0, None

    def add(self, data: bytes) -> None:
        if not self.bytes:
            self.members = zlib.decompressobj(31) if data[:2] == b"\x1f\x8b" else None
        self.bytes += len(data)
        self.sha.update(data)
        try:
            while data and self.members is not None:
                if self.members.eof:
                    self.members = zlib.decompressobj(31)
                self.decoded += len(self.members.decompress(data, STEP))
                data = self.members.unconsumed_tail or self.members.unused_data
        except zlib.error:
            self.members = None

    @property
    def decoded_bytes(self) -> int | None:
        return self.decoded if self.members is not None and self.members.eof else None


def measured(fs: files.FileSystem, path: str) -> Measure:
    m = Measure()
    with fs.open_input_stream(path, compression=None) as f:
        while data := f.read(STEP):
            m.add(data)
    return m


def digest(fs: files.FileSystem, path: str) -> str:
    """The digest of a file, read a piece at a time."""
    sha = hashlib.sha256()
    with fs.open_input_stream(path, compression=None) as f:
        while data := f.read(STEP):
            sha.update(data)
    return sha.hexdigest()


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.options = dict(options)

    def found(self) -> list[tuple[str, int]]:
        return [x for root in json.loads(self.options["roots"]) for x in listed(root)]

    def partitions(self) -> list[InputPartition]:
        return dealt(self.found())


class HashedFiles(DataSource):
    """path, bytes, sha256, decoded_bytes of files below ``roots`` whose name ends as one of ``extensions``, in either case."""

    @classmethod
    def name(cls) -> str:
        return "ledgerloom_files"

    def schema(self) -> str:
        return "path string, bytes long, sha256 string, decoded_bytes long"

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _HashedReader(self.options)


class _HashedReader(_Reader):
    def found(self) -> list[tuple[str, int]]:
        ends = tuple(e.lower() for e in json.loads(self.options["extensions"]))
        return [x for root in json.loads(self.options["roots"]) for x in listed(root, lambda name: name.lower().endswith(ends))]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        fs, _ = opened(json.loads(self.options["roots"])[0])
        for path in partition.paths if partition else []:
            m = measured(fs, path)
            yield path, m.bytes, m.sha.hexdigest(), m.decoded_bytes


class StoredObjects(HashedFiles):
    """As ``HashedFiles``, of all that is below ``roots``: each folder there is listed by the task that reads it, so the driver lists
    the folders alone, of which an object store has 256. A task has ``TASK_FOLDERS`` of them, one after the other."""

    @classmethod
    def name(cls) -> str:
        return "ledgerloom_stored"

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _StoredReader(self.options)


class _StoredReader(_HashedReader):
    def partitions(self) -> list[InputPartition]:
        out: list[InputPartition] = []
        for root in json.loads(self.options["roots"]):
            folders, loose = top(root)
            out += [*(Folders(folders[i : i + TASK_FOLDERS]) for i in range(0, len(folders), TASK_FOLDERS)), *dealt(loose)]
        return out

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        if not isinstance(partition, Folders):
            yield from super().read(partition)
            return
        fs, _ = opened(json.loads(self.options["roots"])[0])
        for folder in partition.paths:
            yield from super().read(Files([path for path, _ in below(fs, folder)]))


class JsonPieces(DataSource):
    """path, pos, key, value, error of the values of JSON arrays, or the entries of objects (``kind``), in files below ``roots``;
    ``.gz`` is decoded. A fault ends its file with a row that has an error."""

    @classmethod
    def name(cls) -> str:
        return "ledgerloom_json"

    def schema(self) -> str:
        return "path string, pos long, key string, value string, error string"

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _PiecesReader(self.options)


def read_pieces(fs: files.FileSystem, path: str, kind: str, zipped: bool) -> Iterator[tuple[int, str | None, str | None, str | None]]:
    """(pos, key, value, error) of a file."""
    pos = 0
    with fs.open_input_stream(path, compression=None) as f:
        try:
            for key, value in pieces(unzipped(f) if zipped else f, kind):
                yield pos, key, value, None
                pos += 1
        except JsonError as e:
            yield pos, None, None, str(e)


class _PiecesReader(_Reader):
    def read(self, partition: InputPartition) -> Iterator[tuple]:
        fs, _ = opened(json.loads(self.options["roots"])[0])
        for path in partition.paths if partition else []:
            for row in read_pieces(fs, path, self.options["kind"], path.lower().endswith(".gz")):
                yield path, *row


@dataclass
class Stored(WriterCommitMessage):
    written: int
    present: int


class ObjectStore(DataSource):
    """Writes rows (content, extension) as files ``objects/<2>/<sha256><extension>`` below ``path``."""

    @classmethod
    def name(cls) -> str:
        return "ledgerloom_objects"

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceArrowWriter:
        if overwrite:
            raise ValueError("objects are only added")
        return ObjectWriter(self.options["path"], int(self.options["most"]))


class ObjectWriter(DataSourceArrowWriter):
    """A task writes its new objects to a folder of its attempt, and renames them to their places once it has all of them. What
    already stands in a place is not written again; it is read and must have the digest that the place says. An attempt that fails
    takes its folder with it, and the driver deletes what lost ones have left. As places follow from content, an attempt that runs
    twice, or two tasks with the same content, come to the same files."""

    def __init__(self, root: str, most: int = OBJECT_BYTES):
        self.root, self.most, self.job = root, most, f".pending-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Stored:
        fs, root = opened(self.root)
        own = f"{root}/{self.job}/{uuid.uuid4().hex}"
        fs.create_dir(own, recursive=True)
        seen: set[bytes] = set()
        new: list[str] = []
        folders: set[str] = set()
        done = Stored(0, 0)
        try:
            for batch in iterator:
                for content, ext in zip(batch.column("content"), batch.column("extension").to_pylist(), strict=True):
                    data = content.as_buffer()
                    if data is None:
                        continue
                    if data.size > self.most:
                        raise ValueError(f"an object has {data.size} bytes; the most are {self.most}")
                    sha = hashlib.sha256(data)
                    key = sha.digest() + ext.encode()
                    if key in seen:
                        continue
                    seen.add(key)
                    name = sha.hexdigest() + ext
                    if not self._stands(fs, root, name, done):
                        with fs.open_output_stream(f"{own}/{name}", compression=None, buffer_size=None) as f:
                            f.write(data)
                        new.append(name)
            for name in new:
                # Another task may have had the same content meanwhile.
                if not self._stands(fs, root, name, done):
                    folder = f"{root}/objects/{name[:2]}"
                    if folder not in folders:
                        fs.create_dir(folder, recursive=True)
                        folders.add(folder)
                    fs.move(f"{own}/{name}", f"{folder}/{name}")
                    done.written += 1
        finally:
            fs.delete_dir(own)
        return done

    def _stands(self, fs: files.FileSystem, root: str, name: str, done: Stored) -> bool:
        """Whether the object is in its place, whole; a damaged one is an error."""
        path = f"{root}/objects/{name[:2]}/{name}"
        if fs.get_file_info(path).type == files.FileType.NotFound:
            return False
        if digest(fs, path) != name[:64]:
            raise ValueError(f"{path} is damaged")
        done.present += 1
        return True

    def _clear(self) -> None:
        fs, root = opened(self.root)
        if fs.get_file_info(f"{root}/{self.job}").type != files.FileType.NotFound:
            fs.delete_dir(f"{root}/{self.job}")

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        self._clear()

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        self._clear()


def _read(spark: SparkSession, source: type[DataSource], **options) -> DataFrame:
    spark.dataSource.register(source)
    return spark.read.format(source.name()).options(**{k: v if isinstance(v, str) else json.dumps(v) for k, v in options.items()}).load()


def scan_files(spark: SparkSession, root: str, extensions: list[str]) -> DataFrame:
    """path, bytes, sha256 of files below ``root`` with one of the extensions, in either case; files of any size."""
    return _read(spark, HashedFiles, roots=[root], extensions=extensions).select("path", "bytes", "sha256")


def scan_objects(spark: SparkSession, root: str) -> DataFrame:
    """path (below ``root``), sha, bytes, decoded_bytes of all that stands in an object store; ``decoded_bytes`` is null where the
    content is not gzip."""
    rows = _read(spark, StoredObjects, roots=[f"{root.rstrip('/')}/objects"])
    return rows.select(F.regexp_extract("path", "objects/[^/]*/[^/]*$", 0).alias("path"), F.col("sha256").alias("sha"), "bytes", "decoded_bytes")


def scan_pack_array(spark: SparkSession, paths: list[str]) -> DataFrame:
    """pack (path), pos, row (variant), error of JSON array files, or of those in folders."""
    rows = _read(spark, JsonPieces, roots=paths, kind="array")
    row = F.try_parse_json("value")
    return rows.select(F.col("path").alias("pack"), "pos", row.alias("row"), F.when(row.isNull(), F.coalesce("error", F.lit("no JSON value"))).alias("error"))


def scan_catalog_map(spark: SparkSession, path: str, value_schema: T.DataType) -> DataFrame:
    """key, value, error of a JSON object file, or of those in a folder; a repeated key has a row each time."""
    return _read(spark, JsonPieces, roots=[path], kind="object").select("key", F.from_json("value", value_schema).alias("value"), "error")


def addressed_objects(df: DataFrame, content: Column, ext: str) -> DataFrame:
    """path, prefix, sha256, bytes of each distinct content that is not null."""
    out = df.select(F.sha2(content, 256).alias("sha256"), F.octet_length(content).cast("long").alias("bytes")).filter("sha256 IS NOT NULL").distinct()
    return out.select(object_path(F.col("sha256"), ext).alias("path"), F.substring("sha256", 1, 2).alias("prefix"), "sha256", "bytes")


def write_content_addressed(df: DataFrame, content: Column, ext: str, root: str, most: int = OBJECT_BYTES) -> DataFrame:
    """Add the objects that ``root`` does not hold yet, and check those that it does; returns what was asked for, one row a content.

    Rows are not shuffled: a content that stands in several tasks is written by one of them and checked by the others."""
    df.sparkSession.dataSource.register(ObjectStore)
    rows = df.select(content.cast("binary").alias("content"), F.lit(ext).alias("extension"))
    rows.write.format(ObjectStore.name()).option("path", root).option("most", most).mode("append").save()
    return addressed_objects(df, content, ext)
