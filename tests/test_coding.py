"""The choice between plain and indexed values, and its index."""

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import joins as J
from ledgerloom.operators import tables as A

COLOURS = [bytes([17, 29, 43, 0]), bytes([17, 29, 43, 1]), bytes([220, 61, 8, 255])]
PICTURES = {
    "blocks": [COLOURS[(x // 8 + y // 8) % 3] for y in range(128) for x in range(128)],  # the hidden colour under zero alpha counts
    "many": [bytes([n & 255, n >> 8, 7, 255]) for n in range(257)] + [bytes(4)] * 15,
    "small": [COLOURS[(x + y + 9) % 3] for y in range(16) for x in range(16)],
}


def table(spark, parts, kind="binary"):
    return spark.createDataFrame([(k, i, v) for k, values in parts.items() for i, v in enumerate(values)], f"part string, pos int, v {kind}").repartition(3)


@pytest.mark.parametrize("block", [1 << 16, 1000])
def test_pictures(spark, block):
    """Deflated: blocks of three colours are smaller indexed, over 256 colours have no index, a small regular picture is smaller plain."""
    got = {r.part: r for r in A.coding_choice(table(spark, PICTURES), "part", "pos", "v", deflate=True, block=block).collect()}
    assert {k: r.indexed for k, r in got.items()} == {"blocks": True, "many": False, "small": False}
    assert {k: (r.rows, r["values"]) for k, r in got.items()} == {"blocks": (128 * 128, 3), "many": (272, 258), "small": (256, 3)}
    assert got["many"].indexed_bytes is None and all(r.plain_bytes < 4 * r.rows for r in got.values())


def test_bytes_as_they_are(spark):
    """Ties stay plain; nulls are a value without bytes; a part of one value takes a bit a row."""
    parts = {"tie": ["x" * 13] * 2 + ["y" * 12], "less": ["x" * 13] * 3, "null": [None, None, "abc"], "wide": [f"v{i:03d}" * 9 for i in range(17)] * 20}
    got = {r.part: tuple(r)[1:] for r in A.coding_choice(table(spark, parts, "string"), "part", "pos", "v", limit=17, overhead=12).collect()}
    assert got == {"tie": (3, 2, 38, 38, False), "less": (3, 1, 39, 26, True), "null": (3, 2, 3, 16, False), "wide": (340, 17, 340 * 36, 17 * 36 + 340 + 12, True)}


def test_index_by_first_appearance(spark):
    parts = {"a": ["b", "a", "b", None], "over": ["x", "y", "z", "u", "x"], "one": [None]}
    got = {(r.part, r.pos): r["index"] for r in A.dictionary_encode(table(spark, parts, "string"), "part", "pos", "v", limit=3).collect()}
    assert got == {("a", 0): 0, ("a", 1): 1, ("a", 2): 0, ("a", 3): 2, **{("over", i): None for i in range(5)}, ("one", 0): 0}


def test_values_to_cross_with_are_few(spark):
    with pytest.raises(ValueError, match="more than"):
        J.expand_cross(spark.range(2), spark.range(J.MOST_VALUES + 1).select(F.col("id").alias("v")), "v")
