"""Files as they stand in storage: objects under their addresses, hashed files of any size, packs read as streams, releases by pointer."""

import gzip
import hashlib
import io
import json
import os
import subprocess
import sys
import tracemalloc
from types import SimpleNamespace

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerloom.operators import tables as A
from ledgerloom.sources import jsonstream as J
from ledgerloom.sources import releases as P
from ledgerloom.sources import storage as O

c = F.col
HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def files_below(root):
    return sorted(os.path.relpath(os.path.join(d, f), root) for d, _, names in os.walk(root) for f in names)


def address(text, ext=".txt"):
    sha = hashlib.sha256(text.encode()).hexdigest()
    return f"objects/{sha[:2]}/{sha}{ext}"


# --- objects ---------------------------------------------------------------------------------------------------------


def test_objects_stand_at_their_addresses(spark, tmp_path):
    root = str(tmp_path / "store")
    df = spark.createDataFrame([("a",), ("b",), ("a",), (None,), ("",)], "t string").repartition(3)
    told = O.write_content_addressed(df, c("t"), ".txt", root)
    assert {r["path"]: (r["sha256"], r["bytes"]) for r in told.collect()} == {address(t): (address(t)[11:75], len(t)) for t in ("a", "b", "")}
    assert files_below(root) == sorted(address(t) for t in ("a", "b", ""))
    assert all(open(f"{root}/{address(t)}").read() == t for t in ("a", "b", ""))
    before = {f: os.stat(f"{root}/{f}").st_ino for f in files_below(root)}
    O.write_content_addressed(df.union(spark.createDataFrame([("c",)], "t string")), c("t"), ".txt", root)
    after = {f: os.stat(f"{root}/{f}").st_ino for f in files_below(root)}
    assert {f: after[f] for f in before} == before and set(after) - set(before) == {address("c")}


def test_a_damaged_object_is_an_error(spark, tmp_path):
    root = str(tmp_path)
    df = spark.createDataFrame([("a",), ("b",)], "t string").coalesce(1)
    O.write_content_addressed(df, c("t"), ".txt", root)
    with open(f"{root}/{address('a')}", "w") as f:
        f.write("x")
    with pytest.raises(Exception, match="damaged"):
        O.write_content_addressed(df, c("t"), ".txt", root)
    faults = A.verify_objects(spark.createDataFrame([(address(t), address(t)[11:75], 1) for t in "ab"], "path string, sha string, bytes long"), O.scan_objects(spark, root))
    assert [tuple(r) for r in faults.collect()] == [(address("a"), "sha")]
    assert files_below(root) == sorted(map(address, "ab"))


def test_an_aborted_task_leaves_nothing(spark, tmp_path):
    root = str(tmp_path)
    df = spark.createDataFrame([("small",), ("much too long",)], "t string").coalesce(1)
    with pytest.raises(Exception, match="an object has 13 bytes"):
        O.write_content_addressed(df, c("t"), ".txt", root, most=8)
    assert files_below(root) == [] and not any(n.startswith(".pending") for n in os.listdir(root))


def test_attempts_that_run_twice_or_are_lost(tmp_path):
    root = str(tmp_path)
    batch = pa.RecordBatch.from_arrays([pa.array([b"a", b"b", None, b"a"]), pa.array([".bin"] * 4)], ["content", "extension"])
    w = O.ObjectWriter(root)
    first, second = w.write(iter([batch])), w.write(iter([batch]))
    assert (first.written, first.present, second.written, second.present) == (2, 0, 0, 2)
    # A lost attempt has written to its own folder and ended there.
    os.makedirs(f"{root}/{w.job}/lost")
    with open(f"{root}/{w.job}/lost/half", "w") as f:
        f.write("x")
    w.commit([first, second])
    assert files_below(root) == sorted(address(t, ".bin") for t in "ab") and sorted(os.listdir(root)) == ["objects"]

    def broken():
        yield batch
        raise RuntimeError("the task ends here")

    other = O.ObjectWriter(str(tmp_path / "other"))
    with pytest.raises(RuntimeError):
        other.write(broken())
    other.abort([None])
    assert files_below(str(tmp_path / "other")) == []


def test_measured_gzip(spark, tmp_path):
    folder = tmp_path / "objects/aa"
    folder.mkdir(parents=True)
    content = {"whole": gzip.compress(b"x" * 5_000_000), "two": gzip.compress(b"abc") + gzip.compress(b"de"), "cut": gzip.compress(os.urandom(1000))[:-9], "plain": b"text", "empty": b""}
    for k, v in content.items():
        (folder / k).write_bytes(v)
    got = {r["path"].rsplit("/", 1)[1]: (r["sha"], r["bytes"], r["decoded_bytes"]) for r in O.scan_objects(spark, f"file:{tmp_path}").collect()}
    want = {"whole": 5_000_000, "two": 5, "cut": None, "plain": None, "empty": None}
    assert got == {k: (hashlib.sha256(v).hexdigest(), len(v), want[k]) for k, v in content.items()}


# --- files -----------------------------------------------------------------------------------------------------------


def test_files_by_extension(spark, tmp_path):
    for name in ("a.PNG", "sub/b.xnb", "c.txt", "_hidden.png", ".tmp/d.png"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(name.encode())
    got = O.scan_files(spark, str(tmp_path), [".png", ".xnb"]).collect()
    assert {(os.path.relpath(r["path"], tmp_path), r["bytes"], r["sha256"]) for r in got} == {(n, len(n), hashlib.sha256(n.encode()).hexdigest()) for n in ("a.PNG", "sub/b.xnb")}
    (tmp_path / "link.png").symlink_to(tmp_path / "a.PNG")
    with pytest.raises(Exception, match="holds a link"):
        O.scan_files(spark, str(tmp_path), [".png"]).collect()


def test_partitions_are_files(tmp_path):
    mb = 1 << 20
    got = O.dealt([("a", 100 * mb), ("b", 20 * mb), ("c", 20 * mb), ("d", 3000 * mb), ("e", 1), ("f", 1)])
    assert [p.paths for p in got] == [["a", "b"], ["c"], ["d"], ["e", "f"]]


def test_a_file_of_3_gb_in_a_small_worker(tmp_path):
    """Hashed by a process that may have 1 GB of memory."""
    path = tmp_path / "large.bin"
    with open(path, "wb") as f:
        f.write(b"head")
        f.truncate(3 << 30)
    want = hashlib.sha256(b"head")
    for _ in range(3 * 1024):
        want.update(bytes(1 << 20)) if _ else want.update(bytes((1 << 20) - 4))
    code = f"import resource; from ledgerloom.sources import storage as O; resource.setrlimit(resource.RLIMIT_DATA, (1 << 30, 1 << 30)); m = O.measured(*O.opened({str(path)!r})); print(m.bytes, m.sha.hexdigest())"
    out = subprocess.run([sys.executable, "-c", code], cwd=HERE, capture_output=True, text=True, check=True, timeout=120).stdout.split()
    assert out == [str(3 << 30), want.hexdigest()]


# --- JSON streams ----------------------------------------------------------------------------------------------------

values = st.recursive(st.none() | st.booleans() | st.integers() | st.floats(allow_nan=False, allow_infinity=False) | st.text(), lambda x: st.lists(x, max_size=4) | st.dictionaries(st.text(), x, max_size=4), max_leaves=12)


class Trickle(io.RawIOBase):
    """A stream that gives at most so many bytes a read."""

    def __init__(self, data, size):
        self.data, self.size, self.at = data, size, 0

    def read(self, n=-1):
        out = self.data[self.at : self.at + min(self.size, n if n >= 0 else self.size)]
        self.at += len(out)
        return out


@settings(max_examples=150, deadline=None)
@given(st.lists(values, max_size=6), st.integers(1, 9), st.sampled_from([None, 1]), st.booleans())
def test_array_values_as_the_parser_sees_them(items, size, indent, ascii_only):
    data = json.dumps(items, indent=indent, ensure_ascii=ascii_only).encode("utf-8", "surrogatepass")
    try:
        data.decode()
    except UnicodeDecodeError:
        return
    assert [json.loads(v) for _, v in J.pieces(Trickle(data, size), "array")] == json.loads(data)


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.text(st.characters(exclude_categories=["Cs"])), values, max_size=6), st.integers(1, 9))
def test_object_entries_as_the_parser_sees_them(items, size):
    data = json.dumps(items).encode()
    assert [(k, json.loads(v)) for k, v in J.pieces(Trickle(data, size), "object")] == list(json.loads(data).items())


@pytest.mark.parametrize(
    ("text", "kind", "found", "error"),
    [
        ("[1, 2] ", "array", 2, None), ("[]", "array", 0, None), (" { } ", "object", 0, None), ("[1] 2", "array", 1, "trailing data"), ("[1]]", "array", 1, "trailing data"), ("[1,]", "array", 1, "no JSON value"),
        ("[1 2]", "array", 1, "expected , or ]"), ("[1, 2", "array", 2, "cut off"), ("[1, tr", "array", 1, "cut off"), ("", "array", 0, "no array"), ("{}", "array", 0, "no array"), ("[NaN]", "array", 0, "NaN is no JSON"),
        ('["a\nb"]', "array", 0, "no JSON value"), ('{"a": 1, "b"}', "object", 1, "expected :"), ('{"a": 1, 2: 3}', "object", 1, "expected a key"), ('{"a": 1}{}', "object", 1, "trailing data"), ('["\\ud8"]', "array", 0, "no JSON value"),
        ("[" * 100_000, "array", 0, "nested too deep"), ('["abc', "array", 0, "cut off"),
    ],
)
def test_faults_of_a_stream(text, kind, found, error):
    for size in (1, 3, 1 << 20):
        if len(text) > 1000 and size < 4:
            continue
        got, fault = 0, None
        try:
            for _ in J.pieces(Trickle(text.encode(), size), kind):
                got += 1
        except J.JsonError as e:
            fault = str(e)
        assert (got, fault) == (found, error) or (error in ("no JSON value", "cut off") and (got, fault) in ((found, "cut off"), (found, "no JSON value"))), (size, got, fault)


def test_memory_does_not_follow_the_stream():
    class Long:
        left = 60_000

        def read(self, n):
            if self.left == 60_000:
                self.left -= 1
                return b"["
            if self.left > 0:
                self.left -= 200
                return (b'{"id": 12, "text": "%s"},' % (b"x" * 500)) * 200
            self.left, last = -1, b"0]" if self.left >= 0 or self.left > -200 else b""
            return last if not hasattr(self, "done") and not setattr(self, "done", True) else b""

    tracemalloc.start()
    n = sum(1 for _ in J.pieces(Long(), "array"))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n > 50_000 and peak < 8e6, (n, peak)


def test_packs_and_catalogs(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"id":3},\n{"id":1}]\n')
    (tmp_path / "b.json.gz").write_bytes(gzip.compress(b'["x"]'))
    (tmp_path / "c.json.gz").write_bytes(gzip.compress(b'["x", "y"]' * 1)[:-6])
    (tmp_path / "d.json").write_text('[1] [2]')
    (tmp_path / "e.json").write_bytes(b'["\xff"]')
    got = O.scan_pack_array(spark, [str(tmp_path)]).select(F.regexp_extract("pack", "[^/]*$", 0).alias("pack"), "pos", F.to_json("row").alias("row"), "error").collect()
    assert sorted(map(tuple, got), key=str) == sorted([("a.json", 0, '{"id":3}', None), ("a.json", 1, '{"id":1}', None), ("b.json.gz", 0, '"x"', None), *[("c.json.gz", i, f'"{x}"', None) for i, x in enumerate("xy")][: sum(r["pack"] == "c.json.gz" for r in got) - 1],
        ("c.json.gz", sum(r["pack"] == "c.json.gz" for r in got) - 1, None, "broken gzip"), ("d.json", 0, "1", None), ("d.json", 1, None, "trailing data"), ("e.json", 0, None, "no UTF-8")], key=str)
    catalog = tmp_path / "catalog"
    catalog.mkdir()
    (catalog / "c.json").write_text('{"k/1":{"width":2,"height":3}} true')
    kind = spark.createDataFrame([], "width int, height int").schema
    assert [tuple(r) for r in O.scan_catalog_map(spark, str(catalog), kind).select("key", "value.width", "error").collect()] == [("k/1", 2, None), (None, None, "trailing data")]


# --- releases --------------------------------------------------------------------------------------------------------


@pytest.fixture
def release(spark, tmp_path):
    rows = spark.createDataFrame([("f", i, json.dumps({"id": i})) for i in range(10)] + [("g", 1, '{"id":"x"}')], "family string, id int, value string")
    root = str(tmp_path / "repo")
    return SimpleNamespace(root=root, rows=rows, sha=P.write_release(rows, root, "stable", ["id"], 4))


def scanned(spark, root, channel="stable"):
    return sorted(((r["family"], r["pos"], r["row"], r["error"]) for r in P.scan_release_by_pointer(spark, root, channel).select("family", "pos", F.to_json("row").alias("row"), "error").collect()), key=str)


def test_release_rows(spark, release):
    want = sorted([("f", i % 4, f'{{"id":{i}}}', None) for i in range(10)] + [("g", 0, '{"id":"x"}', None)], key=str)
    assert scanned(spark, release.root) == want
    assert scanned(spark, release.root, "next") == [] == scanned(spark, f"{release.root}/nowhere")
    # The same rows give the same release, and no file is written anew.
    before = {f: os.stat(f"{release.root}/{f}").st_ino for f in files_below(release.root) if f.startswith("objects")}
    assert P.write_release(release.rows, release.root, "stable", ["id"], 4) == release.sha
    assert {f: os.stat(f"{release.root}/{f}").st_ino for f in before} == before and len(files_below(release.root)) == len(before) + 2


@pytest.mark.parametrize(
    ("pointer", "error"),
    [("{}", "pointer has no digest"), ("[]", "pointer is no JSON object"), ("{", "pointer is no JSON object"), ('{"manifestSha256": "%s"}' % ("A" * 64), "pointer has no digest"), ('{"manifestSha256": "%s"}' % ("0" * 64), "release is missing"), ("x" * 4097, "stable.json is no file of at most 4096 bytes")],
)
def test_a_bad_pointer_is_never_an_empty_baseline(spark, release, pointer, error):
    with open(f"{release.root}/channels/stable.json", "w") as f:
        f.write(pointer)
    assert scanned(spark, release.root) == [(None, None, None, error)]


def test_a_bad_manifest(spark, release):
    path = f"{release.root}/releases/{release.sha}.json"
    with open(path, "a") as f:
        f.write(" ")
    assert scanned(spark, release.root) == [(None, None, None, "release has another digest")]
    for body, error in (('{"schema": 2, "families": {}}', "release has an unknown schema"), ('{"schema": 1, "families": {"f": {}}}', "family has no packs"), ('{"schema": 1, "families": {"f": {"count": 0, "packs": [1]}}}', "pack is not described")):
        sha = hashlib.sha256(body.encode()).hexdigest()
        with open(f"{release.root}/releases/{sha}.json", "w") as f:
            f.write(body)
        with open(f"{release.root}/channels/stable.json", "w") as f:
            f.write(json.dumps({"manifestSha256": sha}))
        assert [r[3] for r in scanned(spark, release.root)] == [error]


def test_bad_packs_are_rows_beside_good_ones(spark, release):
    """One pack is damaged, one gone, one declares a row too many, one lies at another address; the others are read."""
    manifest = P.resolve(release.root, "stable")[1]
    packs = manifest["families"]["f"]["packs"]
    with open(f"{release.root}/{packs[0]['path']}", "a") as f:
        f.write(" ")
    os.remove(f"{release.root}/{packs[1]['path']}")
    packs[2]["count"] += 1
    manifest["families"]["g"]["packs"][0]["path"] = "objects/00/other.json"
    body = json.dumps(manifest)
    sha = hashlib.sha256(body.encode()).hexdigest()
    for name, text in ((f"releases/{sha}", body), ("channels/stable", json.dumps({"manifestSha256": sha}))):
        with open(f"{release.root}/{name}.json", "w") as f:
            f.write(text)
    got = scanned(spark, release.root)
    assert sorted(r[3] for r in got if r[3]) == sorted(["pack has another digest or size", "pack is missing", "pack declares 3 rows and has 2", "family declares 10 rows, its packs 11", "pack's path is not that of its digest"])
    assert [r[2] for r in got if not r[3]] == ['{"id":8}', '{"id":9}']


# --- stores of very many objects -------------------------------------------------------------------------------------


def test_the_driver_lists_folders_alone(tmp_path, monkeypatch):
    """A partition has a few folders, however many objects stand in them; loose files are read as well, hidden ones are not."""
    for i in range(9):
        (tmp_path / f"{i:02x}").mkdir()
        for k in range(i):
            (tmp_path / f"{i:02x}/{k}.bin").write_bytes(bytes([i, k]))
    (tmp_path / "00/_temporary").write_bytes(b"x")
    (tmp_path / "loose.bin").write_bytes(b"")
    reader = O._StoredReader({"roots": f'["{tmp_path}"]'})
    asked = []
    monkeypatch.setattr(O, "below", lambda fs, folder, f=O.below: (asked.append(folder), f(fs, folder))[1])
    parts = reader.partitions()
    assert len(parts) == 4 and not asked
    got = sorted(r[:3] for p in parts for r in reader.read(p))
    assert got == sorted((p, os.path.getsize(p), hashlib.sha256(open(p, "rb").read()).hexdigest()) for p in (f"{tmp_path}/{x}" for x in files_below(str(tmp_path))) if "_temp" not in p)
    assert len(asked) == 9


def test_what_stands_is_not_written_again(tmp_path, monkeypatch):
    """A second task with the same content opens no file for writing, and checks what is there."""
    import pyarrow as pa

    batch = pa.RecordBatch.from_pylist([{"content": x, "extension": ".bin"} for x in (b"a", b"b", b"a", None)])
    first = O.ObjectWriter(str(tmp_path)).write(iter([batch]))
    assert (first.written, first.present) == (2, 0)
    opened = []

    class Seen(O.files.LocalFileSystem):
        def open_output_stream(self, *args, **more):
            opened.append(args)
            return super().open_output_stream(*args, **more)

    monkeypatch.setattr(O, "opened", lambda uri: (Seen(), uri))
    again = O.ObjectWriter(str(tmp_path)).write(iter([batch]))
    assert (again.written, again.present, opened) == (0, 2, [])
    (tmp_path / address("b", ".bin")).write_bytes(b"c")
    with pytest.raises(ValueError, match="damaged"):
        O.ObjectWriter(str(tmp_path)).write(iter([batch]))


def test_empty_files_come_first(spark, tmp_path):
    for name in "ab":
        (tmp_path / f"{name}.bin").write_bytes(b"")
    assert O.scan_files(spark, f"file:{tmp_path}", [".bin"]).count() == 2
