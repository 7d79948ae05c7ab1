"""Secret scans with structural confirmation.

Three plain patterns find assignments, access keys and hex runs. The method adds spans
that only structure can tell: runs of base64 or hex letters are decoded, and the bytes are
parsed before anything is reported:

* ``der``: nested ASN.1 lengths that fill the whole buffer exactly and start like a private
  key (a sequence whose first member is a small version number, then numbers or an
  algorithm identifier),
* ``openssh``: the magic text followed by length-prefixed strings that stay inside,
* ``sshpub``: a length-prefixed key type followed by length-prefixed members to the end,
* ``jwt``: three url-safe parts, the first two JSON objects, the first naming an algorithm.

Wrapped (PEM-like) blocks are joined over line breaks before they are decoded, also where lines
are indented, quoted or commented, or where the breaks are escaped; both base64 alphabets are
tried. Offsets are code points of the text as it is, ends exclusive.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "der", "openssh", "sshpub", "jwt")
_ASSIGN = re.compile(
    r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
_ASSIGN_HINT = re.compile(r"(?ai:passw|secre|token|api_?k)")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")
_JWT = re.compile(r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]*")
#: A line break in a block of letters: blanks and indentation, quotes and comment marks, or an escaped break.
_BREAK = (
    r"""(?:[ \t]*+(?:\\{1,2}r)?(?:\\{1,2}n)?(?:["'][ \t]*+[+,.]?)?[ \t]*+\\?(?:\r\n?|\n)[ \t]*+(?:[#>*;]+[ \t]*+)?["']?"""
    r"""|(?:\\{1,2}r)?\\{1,2}n[ \t]*+)"""
)
_BREAKS = re.compile(_BREAK)


def _block(letters: str) -> re.Pattern:
    # The letter of an escape is no part of the block behind it.
    return re.compile(rf"(?:(?<![{letters}])(?!(?<=\\)[nrt])|(?<=\\[nrt]))[{letters}]{{40,}}(?:{_BREAK}[{letters}]+)*={{0,2}}")


_BLOCKS = ((_block("A-Za-z0-9+/"), ""), (_block("A-Za-z0-9_-"), "-_"))
_LONG_HEX = re.compile(r"(?<![0-9A-Fa-f])(?:[0-9A-Fa-f]{2}){32,}(?![0-9A-Fa-f])")
_MAGIC = b"openssh-key-v1\x00"
_TYPES = (b"ssh-", b"ecds", b"sk-s", b"sk-e")
_MAX_DEPTH = 12


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """Assignments, access keys and hex runs: leftmost, not overlapping within a kind."""
    found = []
    if _ASSIGN_HINT.search(text):
        found += [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if m.end() - m.start(2) >= 12]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text) if m.end() - m.start() >= 18]
    found += [(m.start(), m.end(), "hex") for m in _HEX.finditer(text)]
    return found


def structural_spans(text: str) -> list[tuple[int, int, str]]:
    """Runs whose decoded bytes parse as a key or a signed token."""
    found = []
    m = _JWT.search(text)
    while m:
        start = m.start() + (text[m.start() - 1 : m.start()] == "\\" and m[0][0] in "nrt")
        if is_signed_token(text[start : m.end()]):
            found.append((start, m.end(), "jwt"))
            m = _JWT.search(text, m.end())
        else:
            m = _JWT.search(text, m.start() + m[0].index(".") + 1)
    for block, marks in _BLOCKS:
        for m in block.finditer(text):
            if not marks or any(x in m[0] for x in marks):
                found += _wrapped(text, m, marks)
    for m in _LONG_HEX.finditer(text):
        kind = key_kind(bytes.fromhex(m[0]))
        if kind:
            found.append((m.start(), m.end(), kind))
    return found


def _wrapped(text: str, m: re.Match, marks: str) -> list[tuple[int, int, str]]:
    """The longest runs of whole lines that parse: other lines may stand around a wrapped key."""
    breaks = [b.span() for b in _BREAKS.finditer(text, m.start(), m.end())]
    starts = [m.start(), *(b for _, b in breaks)]
    ends = [*(a for a, _ in breaks), m.end()]
    found, first = [], 0
    while first < len(starts):
        if not text.startswith(("M", "b3Bl", "AAAA"), starts[first]):  # what the three kinds of bytes begin with
            first += 1
            continue
        last, kind = _parsed(text, starts, ends, first, marks)
        if kind and (not marks or any(x in text[starts[first] : ends[last]] for x in marks)):
            found.append((starts[first], ends[last], kind))
            first = last
        first += 1
    return found


def _parsed(text: str, starts: list[int], ends: list[int], first: int, marks: str) -> tuple[int, str | None]:
    """The last line up to which the bytes from the first line on are a key."""

    def plain(letters: str) -> str:
        return letters.translate(str.maketrans("-_", "+/")) if marks else letters

    head = unbase64(plain(text[starts[first] : starts[first] + 32]))
    if not head.startswith((b"\x30", _MAGIC)) and not (head[:3] == b"\x00\x00\x00" and head[4:8] in _TYPES):
        return first, None
    most = max(_ends(head)) if head[0] == 0x30 else None
    lines, sizes, n = [], [], 0
    for at in range(first, len(starts)):
        lines.append(text[starts[at] : ends[at]].rstrip("="))
        n += len(lines[-1])
        sizes.append(-1 if n % 4 == 1 else n * 3 // 4)  # one letter over is no byte
        if most is not None and n * 3 // 4 >= most:
            break
    if most is not None and sizes[-1] != most:
        return first, None
    letters = plain("".join(lines))
    data = unbase64(letters[: len(letters) - (len(letters) % 4 == 1)])
    whole = _ends(data)
    for last in range(len(sizes) - 1, -1, -1):
        if sizes[last] > 0 and (whole is None or sizes[last] in whole):
            return first + last, key_kind(data[: sizes[last]])
    return first, None


def _ends(data: bytes) -> set[int] | None:
    """Lengths at which the bytes can end; any, if their beginning does not tell."""
    if data.startswith(_MAGIC):
        return None
    if data[:1] == b"\x30":
        count = data[1] & 0x7F if len(data) > 1 and data[1] & 0x80 else 0
        size = int.from_bytes(data[2 : 2 + count], "big") if count else data[1] if len(data) > 1 else 0
        return {2 + count + size}
    out, at = set(), 0
    while at + 4 <= len(data):
        at += 4 + int.from_bytes(data[at : at + 4], "big")
        out.add(at)
    return out


def unbase64(letters: str) -> bytes:
    """The decoded bytes, or none if the letters are no base64."""
    try:
        return base64.b64decode(letters + "=" * (-len(letters) % 4), validate=True)
    except (binascii.Error, ValueError):
        return b""


def key_kind(data: bytes) -> str | None:
    if len(data) < 24:
        return None
    if data.startswith(_MAGIC):
        return "openssh" if _counted(data, len(_MAGIC), 3, whole=False) else None
    if data[0] == 0x30:
        return "der" if is_private_key(data) else None
    if data[:3] == b"\x00\x00\x00" and data[4:8] in _TYPES:
        return "sshpub" if _counted(data, 0, 2, whole=True) else None
    return None


def _counted(data: bytes, at: int, least: int, whole: bool) -> bool:
    """Do length-prefixed strings follow one another inside the buffer?"""
    n = 0
    while at + 4 <= len(data) and (whole or n < least):
        size = int.from_bytes(data[at : at + 4], "big")
        if at + 4 + size > len(data):
            return False
        at, n = at + 4 + size, n + 1
    return n >= least and (not whole or at == len(data))


def members(data: bytes, start: int, end: int, depth: int = 0) -> list[tuple[int, int, int]] | None:
    """Tags and content ranges that fill ``data[start:end]`` exactly, checked at every level."""
    out: list[tuple[int, int, int]] = []
    at = start
    while at < end:
        if at + 2 > end or depth > _MAX_DEPTH:
            return None
        tag, size, at = data[at], data[at + 1], at + 2
        if size & 0x80:
            count = size & 0x7F
            if not 1 <= count <= 4 or at + count > end or data[at] == 0:
                return None
            size, at = int.from_bytes(data[at : at + count], "big"), at + count
            if size < 0x80:
                return None
        if at + size > end or (tag & 0x20 and members(data, at, at + size, depth + 1) is None):
            return None
        out.append((tag, at, at + size))
        at += size
    return out


def is_private_key(data: bytes) -> bool:
    """A sequence filling the buffer: version, then eight numbers, or algorithm and octets, or octets."""
    top = members(data, 0, len(data))
    if not top or len(top) != 1 or top[0][0] != 0x30:
        return False
    inner = members(data, top[0][1], top[0][2])
    if not inner or inner[0][0] != 0x02 or inner[0][2] - inner[0][1] != 1 or data[inner[0][1]] > 1:
        return False
    tags = [tag for tag, _, _ in inner[1:]]
    if len(tags) >= 5 and all(tag == 0x02 for tag in tags):
        return True
    if tags[:2] == [0x30, 0x04]:
        algorithm = members(data, inner[1][1], inner[1][2])
        return bool(algorithm) and algorithm[0][0] == 0x06
    return tags[:1] == [0x04]


def is_signed_token(run: str) -> bool:
    parts = run.split(".")
    header, claims = _object(parts[0]), _object(parts[1])
    return header is not None and claims is not None and isinstance(header.get("alg"), str)


def _object(letters: str) -> dict | None:
    try:
        value = json.loads(base64.urlsafe_b64decode(letters + "=" * (-len(letters) % 4)))
    except (binascii.Error, ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def listed(spans: list[tuple[int, int, str]]) -> str:
    """``kind:start:end`` by start, then kind as declared, then end."""
    order = sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in order)


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64())])


def find_secrets(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document row: ``id, secrets (array of kind, start, stop)``, in order.

    A null or empty text has no secrets. Repeated rows are scanned each for itself; other
    columns are ignored. Whole texts are scanned, however long. Nothing is shuffled.
    """
    kind = documents.schema[id_col].dataType.simpleString()
    narrow = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for value in batch.column(1):
                text = value.as_py() or ""
                spans = sorted(
                    set(base_spans(text) + structural_spans(text)), key=lambda s: (s[0], KINDS.index(s[2]), s[1])
                )
                rows.append([{"kind": k, "start": a, "stop": b} for a, b, k in spans])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(_SPAN))], names=["id", "secrets"])

    schema = f"id {kind}, secrets array<struct<kind:string,start:bigint,stop:bigint>>"
    return narrow.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def redact(documents: DataFrame, *, text_col: str = "text", mark: str = "[secret]") -> DataFrame:
    """The documents with every secret span replaced by ``mark``; overlapping spans become one.

    All columns stay, in order; a null text stays null.
    """
    names = documents.columns
    place = names.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for value in batch.column(place):
                text = value.as_py()
                out.append(text if not text else _without(text, base_spans(text) + structural_spans(text), mark))
            columns = [c if i != place else pa.array(out, c.type) for i, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return documents.mapInArrow(run, documents.schema)


def _without(text: str, spans: list[tuple[int, int, str]], mark: str) -> str:
    parts, at, until = [], 0, -1
    for start, end, _ in sorted(spans):
        if start >= until:
            if until >= 0:
                at = until
            parts += [text[at:start], mark]
        until = max(until, end)
    return text if until < 0 else "".join([*parts, text[until:]])
