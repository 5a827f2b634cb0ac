"""Column functions: hashing, JSON identity, paths, colours, arithmetic and arrays."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Base names that are reserved on common platforms.
RESERVED_NAMES = ["con", "prn", "aux", "nul", "com1", "com2", "com3", "com4", "com5", "com6", "com7", "com8", "com9", "lpt1", "lpt2", "lpt3", "lpt4", "lpt5", "lpt6", "lpt7", "lpt8", "lpt9"]
#: The extensions that a public object may have.
PUBLIC_EXTENSIONS = ["json.gz", "png", "zip", "zip.gz", "txci.gz", "srgb.gz", "bin.gz", "json", "bin"]
MAX_OBJECT_BYTES = 128 << 20


# --- hashes and JSON -------------------------------------------------------------------------------------------------


def sha256_hex(x: Column) -> Column:
    return F.sha2(x, 256)


def strict_object(text: Column) -> Column:
    """The text as a variant if it is one JSON object with nothing after it and no key twice; else null."""
    wrapped = F.concat(F.lit("["), text, F.lit("]"))
    one = F.try_parse_json(wrapped).isNotNull() & (F.json_array_length(wrapped) == 1)
    v = F.try_parse_json(text)
    return F.when(one & F.schema_of_variant(v).startswith("OBJECT"), v)


def canonical_json(text: Column) -> Column:
    """JSON with sorted keys at every level and numbers in one form: 1 and 1.0 are equal; null where it does not parse."""
    return F.to_json(F.try_parse_json(text))


def row_hash(text: Column) -> Column:
    return sha256_hex(canonical_json(text))


def canonical_field(value: Column) -> Column:
    """A variant value in canonical form; a JSON null is the text ``null``, an absent value is null."""
    return F.to_json(value)


def json_identity(row: Column) -> Column:
    """The JSON text of a row's ``id``: 1 and "1" differ; null where there is none."""
    return F.to_json(F.variant_get(row, "$.id", "variant"))


def object_path(sha: Column, ext: str = "") -> Column:
    return F.concat(F.lit("objects/"), F.substring(sha, 1, 2), F.lit("/"), sha, F.lit(ext))


def hash_prefix(sha: Column, digits: int = 2) -> Column:
    return F.substring(sha, 1, digits)


# --- predicates ------------------------------------------------------------------------------------------------------


def rule_cascade(rules: list[tuple[Column, str]]) -> Column:
    """The reason of the first rule that holds; null if none does."""
    return F.coalesce(*[F.when(c, F.lit(r)) for c, r in rules], F.lit(None).cast("string"))


def status_classify(rules: list[tuple[Column, str]], default: str) -> Column:
    return F.coalesce(rule_cascade(rules), F.lit(default))


def valid_relative_path(path: Column) -> Column:
    """Null for a portable relative path, else why it is none."""
    parts = F.split(path, "/")
    base = lambda p: F.lower(F.get(F.split(p, r"\."), F.lit(0)))
    odd = lambda p: (p == "") | (p == ".") | (p == "..") | (F.octet_length(p) > 200) | p.rlike("[ .]$")
    # Parts are looked at in turn; within a part its form comes before its name.
    first = F.get(F.filter(parts, lambda p: odd(p) | base(p).isin(RESERVED_NAMES)), F.lit(0))
    return rule_cascade(
        [
            (path.isNull() | (path == "") | (F.octet_length(path) > 600) | path.rlike(r"[\\:\x00]") | path.startswith("/"), "unsafe"),
            (path.rlike(r"[\x01-\x1f]"), "control"),
            (odd(first), "nonportable"),
            (first.isNotNull(), "reserved"),
        ]
    )


def valid_sha(x: Column) -> Column:
    return F.coalesce(x.rlike(r"\A[0-9a-f]{64}\z"), F.lit(False))


def public_path_allowlist(path: Column) -> Column:
    """Whether a path is the channel, a release named by its hash, or an object under its hash's first digits."""
    kinds = "|".join(e.replace(".", r"\.") for e in PUBLIC_EXTENSIONS)
    pattern = rf"\Aobjects/([0-9a-f]{{2}})/([0-9a-f]{{64}})\.({kinds})\z"
    stored = path.rlike(pattern) & (F.substring(path, 9, 2) == F.substring(path, 12, 2))
    return F.coalesce((path == "channels/stable.json") | path.rlike(r"\Areleases/[0-9a-f]{64}\.json\z") | stored, F.lit(False))


def object_path_matches_hash(path: Column, sha: Column, size: Column) -> Column:
    return F.coalesce(valid_sha(sha) & path.startswith(object_path(sha)) & size.between(0, MAX_OBJECT_BYTES), F.lit(False))


def canonical_decimal_string(x: Column) -> Column:
    return F.coalesce(x.rlike(r"\A(0|[1-9][0-9]{0,79})\z"), F.lit(False))


def sorted_unique_array(a: Column) -> Column:
    return a == F.array_sort(F.array_distinct(a))


# --- colours ---------------------------------------------------------------------------------------------------------


def rgb_pack(r: Column, g: Column, b: Column) -> Column:
    return F.shiftleft(r.cast("int"), 16).bitwiseOR(F.shiftleft(g.cast("int"), 8)).bitwiseOR(b.cast("int"))


def rgb_unpack(code: Column) -> Column:
    byte = lambda n: F.shiftright(code, n).bitwiseAND(F.lit(255))
    return F.struct(byte(16).alias("r"), byte(8).alias("g"), byte(0).alias("b"))


def bgr_rank(r: Column, g: Column, b: Column) -> Column:
    return rgb_pack(b, g, r)


def kind_code(kind: Column) -> Column:
    return F.when(kind == "wall", 1).when(kind == "tile", 0)


def packed_kind_type(kind: Column, type_: Column) -> Column:
    """The type with its highest bit set for walls."""
    return type_.cast("int").bitwiseOR(F.when(kind == "wall", 0x8000).otherwise(0))


def brick_address(r: Column, g: Column, b: Column) -> Column:
    """8 x 8 x 8 cells: the brick's number and the cell's in it."""
    at = lambda x, y, z, f, k: (f(x) * k + f(y)) * k + f(z)
    high = lambda x: F.floor(x / 8).cast("int")
    low = lambda x: (x % 8).cast("int")
    return F.struct(at(r, g, b, high, 32).alias("brick"), at(r, g, b, low, 8).alias("cell"))


def frame_xy(style: Column, wrap: Column, line_skip: Column, horizontal: Column, width: Column, height: Column) -> Column:
    """Frame origin of a placement style: styles wrap into lines, along x or y."""
    wraps = wrap > 0
    safe = F.when(wraps, wrap).otherwise(1)
    along = F.when(wraps, style % safe).otherwise(style)
    line = F.when(wraps, F.floor(style / safe) * line_skip).otherwise(0)
    x = F.when(horizontal, width * along).otherwise(width * line)
    y = F.when(horizontal, height * line).otherwise(height * along)
    return F.struct(x.cast("long").alias("x"), y.cast("long").alias("y"))


# --- text, numbers, arrays -------------------------------------------------------------------------------------------


def normalize_asset_path(path: Column) -> Column:
    return F.regexp_replace(F.replace(path, F.lit("\\"), F.lit("/")), r"\A(?i)images/", "")


def extract_all_ids(text: Column, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def ceil_div(a: Column, b: Column | int) -> Column:
    return F.ceil(a / b).cast("long")


def round6(x: Column) -> Column:
    return F.round(x, 6)


def clamp(x: Column, low: Column, high: Column) -> Column:
    return F.least(F.greatest(x, low), high)


def concat_distinct_ordered(*arrays: Column) -> Column:
    return F.array_distinct(F.concat(*arrays))


def drop_default_values(values: Column, defaults: Column) -> Column:
    """Map entries that differ from the default of their key."""
    return F.map_filter(values, lambda k, v: ~v.eqNullSafe(F.element_at(defaults, k)))


def compact_row(*columns: Column) -> Column:
    return F.array(*[c.cast("int") for c in columns])


# --- orders ----------------------------------------------------------------------------------------------------------


def order_numeric_first(x: Column) -> list[Column]:
    """Integers by value, then all other texts by bytes."""
    n = F.when(x.rlike(r"\A[+-]?[0-9]+\z"), x.try_cast("bigint"))
    return [n.isNull(), n, x]


def order_utf16(x: Column) -> list[Column]:
    return [F.encode(x, "UTF-16BE")]


def order_bytes(x: Column) -> list[Column]:
    return [x]


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)
