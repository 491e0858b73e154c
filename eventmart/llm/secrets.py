"""Secret scans through nested encodings: a worklist of decoded layers, each scanned and mapped back.

A text is the first layer. Every decoder that finds something in a layer makes a new one, in which all it
could decode stands decoded in place: percent escapes, backslash escapes, and Base64, whose content may be
zlib or gzip data. Layers go on the worklist until nothing new appears; a layer whose content was seen
before is not taken again, so that cycles end. Each layer is scanned with the same patterns, and findings
are mapped to the characters of the original text they come from.

Base64 may be wrapped in lines and may stand behind other characters of its alphabet, as in a path: a run that
is not Base64 as a whole is searched for packed data behind each separator, then for text at each of the four
alignments. Content is UTF-8, UTF-16 or Latin-1.

Defined cases: a null text is empty; repeated rows are scanned each on its own; Base64 is decoded only where
three quarters of the result are printable text, or compressed data of such. Packed data that would grow beyond
`MAX_UNPACKED` bytes is left packed (a guard against bombs, not a limit on texts) and counted in
`n_left_packed`.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections import deque
from urllib.parse import unquote_to_bytes

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart.llm.arrow import map_texts, utf8
from eventmart.llm.words import LOWER, bounds

# What counts as a secret, as the contract of the query states it. A pattern's first match
# is taken and dropped if it is too short, so the lengths cannot be part of the first one.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_LENGTH = 6
KINDS = ("assign", "access", "hex")

MAX_UNPACKED = 64 << 20

_ESCAPES = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_UNICODE = re.compile(r"\\u\{[0-9A-Fa-f]{1,6}\}|(?:\\u[0-9A-Fa-f]{4})+|\\x[0-9A-Fa-f]{2}|\\U[0-9A-Fa-f]{8}")
# The shortest secret has 12 characters, which are 16 in Base64. More lines may follow.
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}(?:\r?\n[\x20\t]*[A-Za-z0-9+/_-]{2,})*={0,2}")
_LINE = re.compile(r"[A-Za-z0-9+/_-]+")
_SEPARATED = re.compile(r"(?<=[/_-])[A-Za-z0-9+]")
# Text within decoded bytes: one byte a character, or two.
_STRETCH = re.compile(
    rb"(?:[\t\n\r\x20-\x7E]\x00){12,}|(?:\x00[\t\n\r\x20-\x7E]){12,}|[\t\n\r\x20-\x7E]{12,}"
)
_PLAIN = bytes([9, 10, 13, *range(32, 127)])
_STANDARD = str.maketrans("-_", "+/")

_BASE64_BYTES = np.zeros(256, bool)
_BASE64_BYTES[[*range(48, 58), *range(65, 91), *range(97, 123), *b"+/_-"]] = True
_HEX_BYTES = np.zeros(256, bool)
_HEX_BYTES[[*range(48, 58), *range(97, 103)]] = True
# One of these, in lower case, is in every text that has an assignment or an access key.
_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key", b"akia")

SPAN = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("start", T.LongType()),
        T.StructField("end", T.LongType()),
        T.StructField("layer", T.IntegerType()),
    ]
)
RESULTS = T.StructType(
    [
        T.StructField("secret_spans", T.ArrayType(SPAN)),
        T.StructField("n_layers", T.LongType()),
        T.StructField("n_left_packed", T.LongType()),
    ]
)

Found = tuple[int, int, int]  # start, kind, end


def scan_text(text: str) -> list[Found]:
    """Secrets in one layer, leftmost and non-overlapping for each kind."""
    found = [
        (m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LENGTH
    ]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    return found + [(m.start(), 2, m.end()) for m in HEX.finditer(text)]


def _mostly_text(text: str) -> bool:
    """Are three quarters of the characters printable?"""
    raw = text.encode("utf-8")
    if (len(raw) - len(raw.translate(None, _PLAIN))) * 4 >= len(text) * 3:
        return True
    return not text.isascii() and sum(c.isprintable() or c in "\t\n\r" for c in text) * 4 >= len(text) * 3


def _printable(raw: bytes) -> str | None:
    """The text of bytes, None if they are no text for the most part."""
    if not raw:
        return None
    zeros = raw.count(0)
    if zeros * 4 >= len(raw) and len(raw) % 2 == 0:
        code = "utf-16-le" if raw[1::2].count(0) * 2 >= zeros else "utf-16-be"
    else:
        code = "utf-8"
    try:
        text = raw.decode(code)
        return text if _mostly_text(text) else None
    except UnicodeDecodeError:
        # Any bytes are Latin-1, so that only plain characters speak for it.
        plain = len(raw) - len(raw.translate(None, _PLAIN))
        return raw.decode("latin-1") if plain * 4 >= len(raw) * 3 else None


class _TooLarge(Exception):
    pass


def _is_packed(raw: bytes) -> bool:
    """Do these bytes begin like zlib or gzip data?"""
    return raw[:2] == b"\x1f\x8b" or (len(raw) > 2 and raw[0] & 15 == 8 and int.from_bytes(raw[:2]) % 31 == 0)


def _unpack(raw: bytes) -> bytes | None:
    """The content of zlib or gzip data, None if it is neither."""
    if not _is_packed(raw):
        return None
    machine = zlib.decompressobj(47)
    try:
        out = machine.decompress(raw, MAX_UNPACKED)
        if machine.unconsumed_tail:
            raise _TooLarge
        return out + machine.flush() if machine.eof else None
    except zlib.error:
        return None


Pieces = list[tuple[int, int, str]]  # start and end in the run, and what stands there decoded


def _url(run: str) -> Pieces:
    raw = unquote_to_bytes(run)
    try:
        return [(0, len(run), raw.decode("utf-8"))]
    except UnicodeDecodeError:
        return [(0, len(run), raw.decode("latin-1"))]


def _unicode(run: str) -> Pieces:
    if run.startswith("\\u") and not run.startswith("\\u{"):
        units = b"".join(int(run[i + 2 : i + 6], 16).to_bytes(2) for i in range(0, len(run), 6))
        try:
            return [(0, len(run), units.decode("utf-16-be"))]
        except UnicodeDecodeError:
            return []
    code = int(run[3:-1] if run.startswith("\\u{") else run[2:], 16)
    return [(0, len(run), chr(code))] if code < 0x110000 and not 0xD800 <= code < 0xE000 else []


def _content(body: str) -> str | None:
    """The text that Base64 without its padding holds, packed or not."""
    if len(body) % 4 == 1:
        return None
    raw = base64.b64decode(body + "=" * (-len(body) % 4))
    unpacked = _unpack(raw)
    # Packed data may itself be packed.
    while unpacked is not None:
        raw, unpacked = unpacked, _unpack(unpacked)
    return _printable(raw)


def _packed_from(body: str, begin: int) -> tuple[int, str] | None:
    """Packed data that begins here, however it goes on: where it ends, and its text. Read until it fails."""
    if not _is_packed(base64.b64decode(body[begin : begin + 4].ljust(4, "A"))):
        return None
    machine, out, size, step = zlib.decompressobj(47), [], 0, 1 << 14
    try:
        for at in range(begin, len(body), step):
            part = body[at : at + step]
            part = part[: len(part) - 1] if len(part) % 4 == 1 else part
            out.append(machine.decompress(base64.b64decode(part + "=" * (-len(part) % 4)), MAX_UNPACKED + 1 - size))
            size += len(out[-1])
            if not size:
                # A header that goes on for so long is none.
                return None
            if size > MAX_UNPACKED:
                raise _TooLarge
            if machine.eof:
                raw = b"".join(out)
                unpacked = _unpack(raw)
                while unpacked is not None:
                    raw, unpacked = unpacked, _unpack(unpacked)
                text = _printable(raw)
                # What follows the data is no part of it.
                end = min(len(body), at + -(-(len(part) * 3 // 4 - len(machine.unused_data)) * 4 // 3))
                return None if text is None else (end, text)
    except zlib.error:
        pass
    return None


def _within(run: str, body: str) -> Pieces:
    """Base64 within a run of its alphabet that is none as a whole. `body` is the run in the standard alphabet."""
    found, end = [], 0
    for m in _SEPARATED.finditer(run):
        if m.start() >= end:
            own = _packed_from(body, m.start())
            if own is not None:
                end = own[0]
                found.append((m.start(), end, own[1]))
    if found:
        return found
    for shift in range(4):
        size = (len(body) - shift) // 4 * 4
        tail = len(body) - shift - size
        part = body[shift:] if tail != 1 else body[shift : shift + size]
        raw = base64.b64decode(part + "=" * (-len(part) % 4))
        for m in _STRETCH.finditer(raw):
            a, b = m.span()
            # The characters that hold these bytes.
            found.append((shift + a * 4 // 3, min(len(body), shift - (-b * 4 // 3)), m.group().replace(b"\0", b"").decode("ascii")))
    # The longest count where several alignments give text in the same place.
    taken, mark = [], bytearray(len(body))
    for a, b, own in sorted(found, key=lambda x: (x[0] - x[1], x[0])):
        if mark.find(1, a, b) < 0:
            mark[a:b] = b"\1" * (b - a)
            taken.append((a, b, own))
    return sorted(taken)


def _wrapped(lines: list[tuple[int, int]], k: int) -> int:
    """How many lines from here on belong together: one of 16 characters or more, then lines of its length,
    then one that may be shorter."""
    width, n = lines[k][1] - lines[k][0], 1
    while width >= 16 and k + n < len(lines) and lines[k + n - 1][1] - lines[k + n - 1][0] == width:
        if lines[k + n][1] - lines[k + n][0] > width:
            break
        n += 1
    return n


def _base64(run: str) -> Pieces:
    text = run.translate(_STANDARD)
    lines = [m.span() for m in _LINE.finditer(run)]
    found: Pieces = []
    k = 0
    while k < len(lines):
        n = _wrapped(lines, k)
        block, k = lines[k : k + n], k + n
        new = _content("".join(text[a:b] for a, b in block)) if n > 1 else None
        if new is not None:
            found.append((block[0][0], len(run) if k == len(lines) else block[-1][1], new))
            continue
        # No text together: each by itself.
        for a, b in block:
            if b - a >= 16:
                new = _content(text[a:b])
                if new is not None:
                    found.append((a, len(run) if b == lines[-1][1] else b, new))
                else:
                    found += [(a + x, a + y, own) for x, y, own in _within(run[a:b], text[a:b])]
    return found


_DECODERS = ((_ESCAPES, _url), (_UNICODE, _unicode), (_BASE64, _base64))


def _decode(layer: str, pattern: re.Pattern, decode, starts: np.ndarray, ends: np.ndarray):
    """The layer with what could be decoded in place, and the origin of each of its characters.

    Each character of what is decoded comes from the whole piece that held it. Returns None if
    nothing was decoded, and how many runs were left packed.
    """
    parts, origin_starts, origin_ends, end, packed = [], [], [], 0, 0
    for m in pattern.finditer(layer):
        try:
            pieces = decode(m.group())
        except _TooLarge:
            packed += 1
            continue
        for x, y, new in pieces:
            a, b = m.start() + x, m.start() + y
            if new == layer[a:b]:
                continue
            parts += [layer[end:a], new]
            origin_starts += [starts[end:a], np.full(len(new), starts[a])]
            origin_ends += [ends[end:a], np.full(len(new), ends[b - 1])]
            end = b
    if not parts:
        return None, packed
    return ("".join([*parts, layer[end:]]), np.concatenate([*origin_starts, starts[end:]]),
            np.concatenate([*origin_ends, ends[end:]])), packed


def scan(text: str) -> tuple[list[tuple[str, int, int, int]], int, int]:
    """(kind, start, end, layer) of every secret, number of layers, runs left packed.

    Spans are code points of `text`. One found in several layers is listed once, with the first.
    """
    found = {key: 0 for key in scan_text(text)}
    layers, packed = 1, 0
    seen = {hashlib.sha256(text.encode("utf-8", "surrogatepass")).digest()}
    place = np.arange(len(text))
    work = deque([(text, place, place + 1)])
    while work:
        layer, starts, ends = work.popleft()
        for pattern, decode in _DECODERS:
            made, left = _decode(layer, pattern, decode, starts, ends)
            packed += left
            if made is None:
                continue
            digest = hashlib.sha256(made[0].encode("utf-8", "surrogatepass")).digest()
            if digest in seen:
                continue
            seen.add(digest)
            for a, kind, b in scan_text(made[0]):
                found.setdefault((int(made[1][a]), kind, int(made[2][b - 1])), layers)
            layers += 1
            work.append(made)
    return [(KINDS[kind], a, b, found[a, kind, b]) for a, kind, b in sorted(found)], layers, packed


def suspects(texts) -> np.ndarray:
    """Which of the texts may hold a secret or a layer. All others have neither.

    A secret needs one of a few words or a run of hex digits; a layer needs an escape or a run of the
    Base64 alphabet that can be decoded.
    """
    data, offsets = utf8(texts)
    flag = np.zeros(len(texts), bool)
    if not len(data):
        return flag
    raw = LOWER[data].tobytes()
    at: list[int] = []
    for word in _WORDS:
        found = raw.find(word)
        while found >= 0:
            at.append(found)
            # The rest of this text does not matter.
            own = int(np.searchsorted(offsets, found, side="right"))
            found = raw.find(word, int(offsets[own])) if own < len(offsets) else -1
    marks = [np.array(at, np.int64), np.flatnonzero((data == 0x25) | (data == 0x5C))]
    starts, ends, _ = bounds(data, offsets, _BASE64_BYTES)
    long = np.flatnonzero(ends - starts >= 16)
    hex_before = np.concatenate([[0], np.cumsum(_HEX_BYTES[data], dtype=np.int64)])
    digits = hex_before[ends[long]] - hex_before[starts[long]]
    # Hex digits are of the Base64 alphabet, so that a run of them lies in one of those.
    marks.append(starts[long[digits >= 24]])
    raw = data.tobytes()
    for a, b in zip(starts[long].tolist(), ends[long].tolist(), strict=True):
        run = raw[a:b].decode("ascii")
        try:
            # Packed data may go on in the next line.
            if _is_packed(base64.b64decode(run[:4].translate(_STANDARD))) or _base64(run):
                marks.append(np.array([a]))
        except _TooLarge:
            marks.append(np.array([a]))
    flag[np.searchsorted(offsets, np.concatenate(marks), side="right") - 1] = True
    return flag


def find_secrets(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """`docs` with the secrets of each text: spans by start, kind and end; layer 0 is the text itself."""

    def make():
        def work(texts, batch):
            spans, layers, packed = [], [], []
            for value, suspect in zip(texts.to_pylist(), suspects(texts), strict=True):
                own, n, left = scan(value) if suspect else ([], 1, 0)
                spans.append([{"kind": k, "start": a, "end": b, "layer": at} for k, a, b, at in own])
                layers.append(n)
                packed.append(left)
            return {"secret_spans": spans, "n_layers": layers, "n_left_packed": packed}

        return work

    return map_texts(docs, text, RESULTS, make, keep)


def redact_secrets(docs: DataFrame, text: str = "text", mark: str = "[secret]") -> DataFrame:
    """`docs` with each run of overlapping secrets replaced by `mark`. Other texts stay as they are."""
    schema = T.StructType([T.StructField("_redacted_", T.StringType())])

    def make():
        def work(texts, batch):
            values = texts.to_pylist()
            for k in np.flatnonzero(suspects(texts)):
                value = values[k]
                spans, _, _ = scan(value)
                if spans:
                    parts, end = [], 0
                    for _, a, b, _ in spans:
                        if a >= end:
                            parts += [value[end:a], mark]
                        end = max(end, b)
                    values[k] = "".join([*parts, value[end:]])
            return {"_redacted_": values}

        return work

    out = map_texts(docs, text, schema, make)
    return out.select(*[F.col("_redacted_").alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns])
