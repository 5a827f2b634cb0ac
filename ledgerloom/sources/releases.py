"""Releases in a folder: a channel's pointer, a manifest under its own digest, and packs of rows under the address of their content.

``channels/<channel>.json`` holds ``{"manifestSha256": ...}``; ``releases/<sha>.json`` holds
``{"schema": 1, "families": {name: {"count": n, "packs": [{"path", "sha256", "bytes", "count"}]}}}``.
A scan reads the two small files in the driver, and then only the packs that they list; a pack is read by one task.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs as files
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ledgerloom.operators.windows import row_shard
from ledgerloom.sources.storage import TASK_BYTES, measured, opened, read_pieces, write_content_addressed

SCHEMA = 1
#: The most bytes of a pointer and of a manifest.
POINTER_BYTES, MANIFEST_BYTES = 4096, 256 << 20


class ReleaseError(ValueError):
    pass


def _small(fs: files.FileSystem, path: str, most: int) -> bytes | None:
    """A file's bytes; None if there is no file."""
    info = fs.get_file_info(path)
    if info.type == files.FileType.NotFound:
        return None
    if not info.is_file or info.size > most:
        raise ReleaseError(f"{path.rsplit('/', 1)[-1]} is no file of at most {most} bytes")
    with fs.open_input_stream(path, compression=None) as f:
        return f.read()


def _object(data: bytes, what: str) -> dict:
    try:
        found = json.loads(data)
    except ValueError:
        found = None
    if not isinstance(found, dict):
        raise ReleaseError(f"{what} is no JSON object")
    return found


def resolve(root: str, channel: str) -> tuple[str, dict] | None:
    """Digest and manifest of the release that a channel points to; None where there is no pointer. A pointer that cannot be
    followed is an error, never an empty baseline."""
    fs, base = opened(root)
    data = _small(fs, f"{base}/channels/{channel}.json", POINTER_BYTES)
    if data is None:
        return None
    sha = _object(data, "pointer").get("manifestSha256")
    if not isinstance(sha, str) or not re.fullmatch("[0-9a-f]{64}", sha):
        raise ReleaseError("pointer has no digest")
    body = _small(fs, f"{base}/releases/{sha}.json", MANIFEST_BYTES)
    if body is None:
        raise ReleaseError("release is missing")
    if hashlib.sha256(body).hexdigest() != sha:
        raise ReleaseError("release has another digest")
    manifest = _object(body, "release")
    if manifest.get("schema") != SCHEMA or not isinstance(manifest.get("families"), dict):
        raise ReleaseError("release has an unknown schema")
    return sha, manifest


@dataclass
class Pack:
    family: str | None
    path: str | None
    sha256: str | None
    bytes: int | None
    count: int | None
    error: str | None = None


@dataclass
class Packs(InputPartition):
    packs: list[Pack]


def _described(family: str, pack: object) -> Pack:
    kinds = {"path": str, "sha256": str, "bytes": int, "count": int}
    if not isinstance(pack, dict) or any(not isinstance(pack.get(k), t) for k, t in kinds.items()):
        return Pack(family, None, None, None, None, "pack is not described")
    p = Pack(family, *[pack[k] for k in kinds])
    if not re.fullmatch(rf"objects/{p.sha256[:2]}/{p.sha256}(\.[a-z0-9]+)+", p.path):
        p.error = "pack's path is not that of its digest"
    return p


def packs_of(manifest: dict) -> list[Pack]:
    """The packs of a manifest; what is wrong with the manifest itself as packs that only have an error."""
    out = []
    for family, body in sorted(manifest["families"].items()):
        if not isinstance(body, dict) or not isinstance(body.get("packs"), list):
            out.append(Pack(family, None, None, None, None, "family has no packs"))
            continue
        mine = [_described(family, p) for p in body["packs"]]
        total = sum(p.count or 0 for p in mine)
        if body.get("count") != total:
            mine.append(Pack(family, None, None, None, None, f"family declares {body.get('count')} rows, its packs {total}"))
        out += mine
    return out


class Release(DataSource):
    """family, pack, pos, value, error of the rows of the release that ``channel`` points to below ``root``."""

    @classmethod
    def name(cls) -> str:
        return "ledgerloom_release"

    def schema(self) -> str:
        return "family string, pack string, pos long, value string, error string"

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _ReleaseReader(self.options["root"], self.options["channel"])


class _ReleaseReader(DataSourceReader):
    def __init__(self, root: str, channel: str):
        self.root, self.channel = root, channel

    def partitions(self) -> list[InputPartition]:
        try:
            found = resolve(self.root, self.channel)
        except ReleaseError as e:
            return [Packs([Pack(None, None, None, None, None, str(e))])]
        out: list[Packs] = []
        total = 0
        for p in packs_of(found[1]) if found else []:
            if not out or total + (p.bytes or 0) > TASK_BYTES:
                out.append(Packs([]))
                total = 0
            out[-1].packs.append(p)
            total += p.bytes or 0
        return out

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        for p in partition.packs if partition else []:
            yield from self._pack(p)

    def _pack(self, p: Pack) -> Iterator[tuple]:
        fault = lambda text: (p.family, p.path, None, None, text)
        if p.error:
            yield fault(p.error)
            return
        fs, base = opened(self.root)
        if fs.get_file_info(f"{base}/{p.path}").type == files.FileType.NotFound:
            yield fault("pack is missing")
            return
        m = measured(fs, f"{base}/{p.path}")
        if m.sha.hexdigest() != p.sha256 or m.bytes != p.bytes:
            yield fault("pack has another digest or size")
            return
        rows = 0
        for pos, _, value, error in read_pieces(fs, f"{base}/{p.path}", "array", p.path.endswith(".gz")):
            yield p.family, p.path, pos, value, error
            rows += error is None
        if rows != p.count:
            yield fault(f"pack declares {p.count} rows and has {rows}")


def scan_release_by_pointer(spark: SparkSession, root: str, channel: str) -> DataFrame:
    """family, pack, pos, row (variant), error of the rows of a channel's release. An absent pointer is an empty baseline: no rows.
    A pointer or manifest that cannot be followed is one row with an error, as is each pack that is missing, has another digest or
    size than its manifest says, breaks off, or holds another number of rows."""
    spark.dataSource.register(Release)
    rows = spark.read.format(Release.name()).option("root", root).option("channel", channel).load()
    row = F.try_parse_json("value")
    bad = F.coalesce("error", F.when(row.isNull(), F.lit("no JSON value")))
    return rows.select("family", "pack", "pos", row.alias("row"), bad.alias("error"))


def write_release(rows: DataFrame, root: str, channel: str, order: list[str], size: int = 4096) -> str:
    """Write rows (family, value as JSON text) in packs of ``size`` rows, then their manifest and the channel's pointer; the digest
    of the manifest. Packs are objects, so those that stand already are not written again. The manifest, with a line a pack, is
    made in the driver."""
    packed = row_shard(rows, ["family"], order, size).groupBy("family", "shard").agg(F.sort_array(F.collect_list(F.struct(*order, "value"))).alias("rows"))
    text = F.concat(F.lit("["), F.array_join(F.transform("rows", lambda x: x["value"]), ","), F.lit("]"))
    packed = packed.select("family", "shard", F.size("rows").alias("count"), text.alias("text"))
    write_content_addressed(packed, F.col("text"), ".json", root)
    families: dict[str, dict] = {}
    for r in packed.select("family", "shard", "count", F.sha2("text", 256).alias("sha"), F.octet_length("text").alias("bytes")).orderBy("family", "shard").collect():
        f = families.setdefault(r["family"], {"count": 0, "packs": []})
        f["count"] += r["count"]
        f["packs"].append({"path": f"objects/{r['sha'][:2]}/{r['sha']}.json", "sha256": r["sha"], "bytes": r["bytes"], "count": r["count"]})
    body = json.dumps({"schema": SCHEMA, "families": families}, sort_keys=True).encode()
    sha = hashlib.sha256(body).hexdigest()
    fs, base = opened(root)
    for folder, name, data in (("releases", sha, body), ("channels", channel, json.dumps({"manifestSha256": sha}).encode())):
        fs.create_dir(f"{base}/{folder}", recursive=True)
        with fs.open_output_stream(f"{base}/{folder}/.{name}.new", compression=None) as f:
            f.write(data)
        fs.move(f"{base}/{folder}/.{name}.new", f"{base}/{folder}/{name}.json")
    return sha
