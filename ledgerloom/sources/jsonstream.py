"""The values of one JSON array, or the entries of one object, read from a stream as it goes.

What is held is the value at hand and a buffer, however long the stream is. The whole
must be one array or object: anything else, anything after it, and JSON's common
extensions (NaN, comments, control characters in texts) are errors.
"""

from __future__ import annotations

import codecs
import gzip
import json
import re
from collections.abc import Iterator
from typing import BinaryIO

#: Bytes read at once, and the most characters of one value.
STEP, LONGEST = 1 << 18, 64 << 20
_SPACE, _NUMBER = re.compile(r"[ \t\n\r]*"), re.compile(r"[-+.0-9Ee]*")


def _no_constant(name: str) -> None:
    raise ValueError(f"{name} is no JSON")


_DECODE = json.JSONDecoder(parse_constant=_no_constant).raw_decode


class JsonError(ValueError):
    pass


class _Buffer:
    def __init__(self, stream: BinaryIO):
        self.stream, self.decode = stream, codecs.getincrementaldecoder("utf-8")().decode
        self.text, self.at, self.ended = "", 0, False

    def more(self) -> bool:
        """Read on; false at the end. As much is read again as is held, so a long value is not tried too often."""
        if self.ended:
            return False
        try:
            data = self.stream.read(max(STEP, len(self.text) - self.at))
            self.ended = not data
            self.text, self.at = self.text[self.at :] + self.decode(data, self.ended), 0
        except (UnicodeDecodeError, OSError, EOFError) as e:
            raise JsonError("broken gzip" if not isinstance(e, UnicodeDecodeError) else "no UTF-8") from e
        return not self.ended

    def peek(self) -> str:
        """The next character that is no white space, or nothing at the end."""
        while True:
            self.at = _SPACE.match(self.text, self.at).end()
            if self.at < len(self.text):
                return self.text[self.at]
            if not self.more():
                return ""

    def take(self, wanted: str) -> str:
        c = self.peek()
        if not c or c not in wanted:
            raise JsonError(f"expected {' or '.join(wanted)}" if c else "cut off")
        self.at += 1
        return c

    def value(self) -> tuple[object, str]:
        """The next value and its text."""
        self.peek()
        while True:
            try:
                found, end = _DECODE(self.text, self.at)
                if self.ended or _NUMBER.match(self.text, self.at).end() < len(self.text):
                    raw, self.at = self.text[self.at : end], end
                    return found, raw
                self.more()  # a number may go on
            except json.JSONDecodeError as e:
                # A fault well before what has been read is one; at its end the value may just go on.
                if self.ended or not e.msg.startswith("Unterminated") and e.pos < len(self.text) - 16:
                    raise JsonError("cut off" if self.ended and e.pos >= len(self.text) else "no JSON value") from e
                if len(self.text) - self.at > LONGEST:
                    raise JsonError("value too long") from e
                self.more()
            except RecursionError as e:
                raise JsonError("nested too deep") from e
            except ValueError as e:
                raise JsonError(str(e)) from e


def pieces(stream: BinaryIO, kind: str) -> Iterator[tuple[str | None, str]]:
    """(key, text) of each entry of an ``object``, or (None, text) of each value of an ``array``; JsonError at a fault."""
    b = _Buffer(stream)
    opened, closed = ("[", "]") if kind == "array" else ("{", "}")
    if b.peek() != opened:
        raise JsonError(f"no {kind}")
    b.at += 1
    if b.peek() == closed:
        b.at += 1
    else:
        while True:
            key = None
            if kind == "object":
                if b.peek() != '"':
                    raise JsonError("expected a key")
                key = b.value()[0]
                b.take(":")
            yield key, b.value()[1]
            if b.take("," + closed) == closed:
                break
    if b.peek():
        raise JsonError("trailing data")


def unzipped(stream: BinaryIO) -> BinaryIO:
    return gzip.GzipFile(fileobj=stream)
