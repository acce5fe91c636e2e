"""Secret scan with structural confirmation.

Assignments, access keys and hex runs are found by pattern.  Whatever may be an encoded key or a
signed token is decoded, base64 or hex, and reported only if its inside holds together: the
lengths of nested DER elements add up, the strings of an SSH key fill the blob (of the newer
private format the first three strings are read), the header of a signed token is JSON that names
an algorithm.

A text is scanned a fixed number of times and a block of wrapped lines decoded at most four times,
so a very long text takes time in proportion to its length.
"""

from __future__ import annotations

import base64
import binascii
import bisect
import itertools
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Kinds in the order that breaks ties of the start.
KINDS = ("assign", "access", "hex", "jwt", "pem", "der", "ssh")

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ASSIGN_CHARS = 12
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")

# An opening brace makes "e" and one of these the first two characters of base64.
TOKEN = re.compile(
    r"(?<![A-Za-z0-9_-])(e[w-z0-9_-][A-Za-z0-9_-]{6,})\.([A-Za-z0-9_-]{2,})\.([A-Za-z0-9_-]*)"
)
PEM = re.compile(r"-----BEGIN ((?:[A-Z0-9]+ )*PRIVATE KEY)-----")
# Escaped characters in JSON or code, and a line end after a backslash.
_ESCAPED = re.compile(r"(?<!\\)\\++(?:u00([0-9A-Fa-f]{2})|([nrt/])|\r?\n)")
_PROC_TYPE = re.compile(r"Proc-Type:[\x20\t]*4,[\x20\t]*[A-Z-]+")
_DEK_INFO = re.compile(r"DEK-Info:[\x20\t]*([A-Za-z0-9-]+)(?:,[\x20\t]*([0-9A-Fa-f]+))?")
# Between string literals of adjacent lines, and comment marks before a line.
_LITERALS = re.compile(r"[\"'`][\x20\t]*+[+.,&]?\s*+[\"'`]")
_LINE_MARK = re.compile(r"^[\x20\t]*(?:[#>*;|]+|//+(?=[\x20\t]))", re.MULTILINE)
ENCODED = re.compile(r"[A-Za-z0-9+/_-]{40,}={0,2}")
_LINE_BREAK = (
    r"(?:[\x20\t]|[\"'`][\x20\t]*+[+.,&]?|\\(?=\r?\n))*+(?:\\+[nr]|\r?\n)"
    r"(?:[\x20\t\r\n#>*;|]|\\+[nr]|[\"'`](?:[\x20\t]*+[+.,&](?=\s))?|//+(?=[\x20\t]))*+"
)
#: Encoded lines, one after another; the n of an escaped line end is not one of theirs.
WRAPPED = re.compile(
    rf"(?:(?<=\\)[nr]|(?<![A-Za-z0-9+/_-]))[A-Za-z0-9+/_-]{{40,}}+"
    rf"(?:{_LINE_BREAK}[A-Za-z0-9+/_-]++)+={{0,2}}"
)
_LINE = re.compile(r"(?:(?<=\\)[nr])?([A-Za-z0-9+/_-]+)")
_JOINT = re.compile(_LINE_BREAK)
HEX_BLOB = re.compile(r"[0-9A-Fa-f]{64,}")
KEYWORDS = ("password", "passwd", "secret", "token", "api_key", "apikey")

SEQUENCE, INTEGER, BIT_STRING, OCTET_STRING = 0x30, 0x02, 0x03, 0x04
SSH_MAGIC = b"openssh-key-v1\0"
#: Of formats of keys: none has more elements in all, and no SSH key more strings.
MAX_ELEMENTS = 1000
MAX_STRINGS = 16
SSH_NAMES = (b"ssh-", b"ecdsa-", b"sk-ssh-", b"sk-ecdsa-")


def from_base64(text: str) -> bytes | None:
    """The bytes of base64 in either alphabet, with or without padding."""
    text = text.rstrip("=").replace("-", "+").replace("_", "/")
    if len(text) % 4 == 1:
        return None
    try:
        return base64.b64decode(text + "=" * (-len(text) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def der_elements(data: bytes) -> list[tuple[int, int]] | None:
    """(tag, length) of the elements that fill ``data``; None if lengths do not add up.

    Elements may be nested to any depth; data with more of them than any key has is no key.
    """
    found: list[tuple[int, int]] = []
    at, end, ends = 0, len(data), []
    for _ in range(MAX_ELEMENTS + 1):
        while at == end and ends:
            end = ends.pop()
        if at == end:
            return found
        if at + 2 > end:
            return None
        tag, length, at = data[at], data[at + 1], at + 2
        if tag & 0x1F == 0x1F:
            return None
        if length & 0x80:
            size = length & 0x7F
            if not 1 <= size <= 4 or at + size > end:
                return None
            length, at = int.from_bytes(data[at : at + size], "big"), at + size
            if length < 0x80:
                return None
        if at + length > end:
            return None
        if not ends:
            found.append((tag, length))
        if tag & 0x20:
            ends.append(end)
            end = at + length
        else:
            at += length
    return None


def is_der_key(data: bytes | None) -> bool:
    """A DER sequence that fills the data and is laid out as a private or public key is."""
    if not data or len(data) < 24 or data[0] != SEQUENCE:
        return False
    outer = der_elements(data)
    if not outer or len(outer) != 1:
        return False
    size = data[1]
    inner = data[2 + (size & 0x7F if size & 0x80 else 0) :]
    tags = [tag for tag, _ in der_elements(inner) or []]
    integers = [length for tag, length in der_elements(inner) or [] if tag == INTEGER]
    return (
        len(integers) >= 6 and len(integers) == len(tags)
        or tags[:3] == [INTEGER, SEQUENCE, OCTET_STRING]
        or tags[:2] == [INTEGER, OCTET_STRING]
        or tags == [SEQUENCE, BIT_STRING]
        or tags == [INTEGER, INTEGER] and max(integers) >= 64
        or tags == [SEQUENCE, OCTET_STRING]
    )


def is_ssh_key(data: bytes | None) -> bool:
    """An SSH key: a known name, then strings whose lengths fill the blob."""
    if not data:
        return False
    if data.startswith(SSH_MAGIC):
        strings = _ssh_strings(data[len(SSH_MAGIC) :], 3)
        return strings is not None
    strings = _ssh_strings(data, None)
    return bool(strings) and len(strings) >= 2 and strings[0].startswith(SSH_NAMES)


def _ssh_strings(data: bytes, count: int | None) -> list[bytes] | None:
    found, at = [], 0
    while at < len(data) and (count is None or len(found) < count):
        if at + 4 > len(data) or len(found) == MAX_STRINGS:
            return None
        length = int.from_bytes(data[at : at + 4], "big")
        if at + 4 + length > len(data):
            return None
        found.append(data[at + 4 : at + 4 + length])
        at += 4 + length
    return found if count is None or len(found) == count else None


def is_token(header: str, body: str) -> bool:
    """A signed token: the header is a JSON object that names its algorithm."""
    raw = from_base64(header)
    if not raw or not raw.startswith(b"{") or from_base64(body) is None:
        return False
    try:
        parsed = json.loads(raw)
    except (ValueError, RecursionError):
        return False
    return isinstance(parsed, dict) and isinstance(parsed.get("alg"), str)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans (kind, start, end) by pattern alone, each kind leftmost and without overlap."""
    found = []
    folded = text.lower()
    if any(word in folded for word in KEYWORDS):
        found += [
            ("assign", m.start(), m.end())
            for m in ASSIGN.finditer(text)
            if len(m.group(2)) >= ASSIGN_CHARS
        ]
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text)]
    found += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return found


def _unescaped(m: re.Match) -> str:
    if m[1]:
        return chr(int(m[1], 16))
    return "/" if m[2] == "/" else "\n"


def is_pem_key(body: str) -> bool:
    """What lies between the lines of a PEM key: a key, or one encrypted as its headers say."""
    body = _ESCAPED.sub(_unescaped, body)
    encrypted = _DEK_INFO.search(body) if _PROC_TYPE.search(body) else None
    body = _DEK_INFO.sub("", _PROC_TYPE.sub("", body))
    body = _LINE_MARK.sub("", _LITERALS.sub("\n", body))
    if ":" in body:
        # Other headers end at the first blank line, or with the last line that has a colon.
        tail = body[body.rindex(":") :]
        blank = re.search(r"\n[\x20\t\r]*\n", tail)
        body = tail[blank.end() :] if blank else tail.partition("\n")[2]
    data = from_base64(re.sub(r"[\s\"'`,]+", "", body))
    if encrypted and data:
        start = len(encrypted[2] or "") // 2
        whole = not encrypted[1].upper().endswith("CBC") or start > 0 and len(data) % start == 0
        return len(data) >= 24 and whole
    return is_der_key(data) or is_ssh_key(data)


def pem_spans(text: str) -> list[tuple[int, int]]:
    """(start, end) of the private keys in PEM; a line end may be escaped."""
    found = []
    for m in PEM.finditer(text):
        # Five dashes end the body, so each is searched for up to the next BEGIN only.
        stop = text.find("-----", m.end())
        last = f"-----END {m[1]}-----"
        if stop >= 0 and text.startswith(last, stop) and is_pem_key(text[m.end() : stop]):
            found.append((m.start(), stop + len(last)))
    return found


def holds_pem(data: bytes | None) -> bool:
    return bool(data) and b"-----BEGIN " in data and bool(pem_spans(data.decode("latin-1")))


class _Lines:
    """The lines of a block of wrapped base64, and what any stretch of them decodes to.

    The whole block is decoded at most once for each of the four places at which a stretch can
    begin within a group of four characters.
    """

    def __init__(self, text: str, spans: list[tuple[int, int]]):
        self.spans = spans
        self.joined = "".join([text[a:b] for a, b in spans])
        self.width = [b - a for a, b in spans]
        self.offset = [0, *itertools.accumulate(self.width)]
        # Line with which the lines of the same width end, from the last line back.
        self.same_width_to = list(range(len(spans)))
        for n in range(len(spans) - 2, -1, -1):
            if self.width[n] == self.width[n + 1]:
                self.same_width_to[n] = self.same_width_to[n + 1]
        self._decoded: dict[int, bytes] = {}

    def data(self, first: int, last: int) -> bytes | None:
        """What the lines from ``first`` to ``last`` decode to."""
        start, size = self.offset[first], self.offset[last + 1] - self.offset[first]
        return None if size % 4 == 1 else self._from(start, size)

    def head(self, first: int) -> bytes:
        """The first bytes of line ``first``, as many as tell a key's sort and length."""
        size = min(40, len(self.joined) - self.offset[first])
        return from_base64(self.joined[self.offset[first] : self.offset[first] + size // 4 * 4]) or b""

    def _from(self, start: int, size: int) -> bytes:
        phase = start % 4
        if phase not in self._decoded:
            rest = self.joined[phase:]
            # One character too many for whole bytes holds none.
            self._decoded[phase] = from_base64(rest[:-1] if len(rest) % 4 == 1 else rest) or b""
        at = start // 4 * 3
        return self._decoded[phase][at : at + size * 3 // 4]


def wrapped_spans(text: str) -> list[tuple[str, int, int]]:
    """Keys in base64 that goes over several lines, each span from a line's start to a line's end."""
    found = []
    for block in WRAPPED.finditer(text):
        spans, at = [], block.start()
        while (line := _LINE.match(text, at, block.end())) is not None:
            spans.append(line.span(1))
            joint = _JOINT.match(text, line.end(), block.end())
            if joint is None:
                break
            at = joint.end()
        lines, done = _Lines(text, spans), 0
        for first, (start, _) in enumerate(spans):
            if first < done:
                continue
            fresh = first == done or lines.width[first - 1] != lines.width[first]
            last, kind = _der_end(lines, first), "der"
            if last is None:
                last, kind = _even_end(lines, first, fresh)
            if last is None or last == first:
                continue
            end = block.end() if last == len(spans) - 1 else spans[last][1]
            found.append((kind, start, end))
            done = last + 1
    return found


def _der_end(lines: _Lines, first: int) -> int | None:
    """The line with which the DER key that begins in line ``first`` ends."""
    head = lines.head(first)
    if len(head) < 6 or head[0] != SEQUENCE:
        return None
    size = head[1] & 0x7F if head[1] & 0x80 else 0
    if size > 4:
        return None
    total = 2 + size + (int.from_bytes(head[2 : 2 + size], "big") if size else head[1])
    end = lines.offset[first] + (total * 8 + 5) // 6
    last = bisect.bisect_left(lines.offset, end) - 1
    if end > lines.offset[-1] or lines.offset[last + 1] != end or not _may_be_der(lines, first):
        return None
    return last if is_der_key(lines.data(first, last)) else None


def _may_be_der(lines: _Lines, first: int) -> bool:
    """Whether the outer sequence begins as a key's does, with a number or another sequence."""
    head = lines.head(first)
    size = head[1] & 0x7F if head[1] & 0x80 else 0
    return head[2 + size : 3 + size] in (bytes([INTEGER]), bytes([SEQUENCE]))


def _even_end(lines: _Lines, first: int, fresh: bool) -> tuple[int | None, str]:
    """As above for other keys: lines of one width, then at most one shorter line."""
    if not fresh and not _begins_ssh_key(lines.head(first)):
        return None, "ssh"
    last = lines.same_width_to[first]
    if last + 1 < len(lines.width) and lines.width[last + 1] < lines.width[last]:
        last += 1
    # A word of the next line may look like the last one.
    for end in (last, last - 1):
        if end > first:
            if fresh and holds_pem(lines.data(first, end)):
                return end, "pem"
            if _begins_ssh_key(lines.head(first)) and is_ssh_key(lines.data(first, end)):
                return end, "ssh"
    return None, "ssh"


def _begins_ssh_key(head: bytes) -> bool:
    return head.startswith(SSH_MAGIC) or head[4:].startswith(SSH_NAMES)


def confirmed_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans whose decoded structure was confirmed."""
    found = []
    found += [("jwt", m.start(), m.end()) for m in TOKEN.finditer(text) if is_token(m[1], m[2])]
    pems = pem_spans(text) if "-----BEGIN " in text else []
    found += [("pem", start, end) for start, end in pems]
    blobs = []
    for run in ENCODED.finditer(text):
        blobs.append((run.start(), run.end(), from_base64(run[0])))
        blobs += [
            (run.start() + m.start(), run.start() + m.end(), bytes.fromhex(m[0]))
            for m in HEX_BLOB.finditer(run[0])
            if len(m[0]) % 2 == 0
        ]
    for start, end, data in blobs:
        if is_der_key(data):
            found.append(("der", start, end))
        elif is_ssh_key(data):
            found.append(("ssh", start, end))
        elif holds_pem(data):
            found.append(("pem", start, end))
    if blobs:
        # PEM spans are in order and apart, so only the last to begin before one may hold it.
        begins = [a for a, _ in pems]
        for kind, start, end in wrapped_spans(text):
            before = bisect.bisect_right(begins, start) - 1
            if before < 0 or end > pems[before][1]:
                found.append((kind, start, end))
    return found


def in_order(spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    return sorted(set(spans), key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
SPANS = "array<struct<kind:string,start:bigint,end:bigint>>"


def find_secrets(
    documents: DataFrame, text_col: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """Every row of ``documents`` with ``base_spans`` and ``secret_spans``.

    Both are arrays of (kind, start, end) in code points, the end exclusive, by start and then
    kind; ``secret_spans`` holds the base ones and the confirmed ones.  ``keep`` names the
    columns passed on, all by default; one that has the name of an output is replaced.  A
    null or empty text has no spans; repeated rows are rows of their own; an empty table gives
    no rows.
    """
    outputs = ["base_spans", "secret_spans"]
    kept = [c for c in (documents.columns if keep is None else keep) if c not in outputs]
    rows = documents.select(
        *[documents[c] for c in kept], F.col(text_col).cast("string").alias("__text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, every = [], []
            for scalar in batch.column("__text"):
                text = scalar.as_py() or ""
                own = base_spans(text)
                base.append(_dicts(in_order(own)))
                every.append(_dicts(in_order(own + confirmed_spans(text))))
            arrays = [batch.column(c) for c in kept]
            arrays += [pa.array(base, pa.list_(_SPAN)), pa.array(every, pa.list_(_SPAN))]
            yield pa.RecordBatch.from_arrays(arrays, [*kept, *outputs])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "__text"]
    schema = ", ".join([*fields, f"base_spans {SPANS}", f"secret_spans {SPANS}"])
    return rows.mapInArrow(run, schema)


def _dicts(spans: list[tuple[str, int, int]]) -> list[dict]:
    return [{"kind": k, "start": a, "end": b} for k, a, b in spans]


MASK = "[SECRET]"


def mask(text: str, spans: list[tuple[str, int, int]]) -> str:
    """``text`` with every stretch that spans cover replaced by one mask."""
    out, at = [], 0
    for _, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= at:
            out += [text[at:start], MASK]
        at = max(at, end)
    return "".join(out) + text[at:]


def mask_secrets(
    documents: DataFrame, text_col: str = "text", length_col: str | None = "n_chars"
) -> DataFrame:
    """``documents`` with every secret in the text masked; all rows and columns stay.

    A null text stays null.  ``length_col``, if it is there, follows the new text.
    """
    columns = documents.columns
    at = columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for scalar in batch.column(at):
                text = scalar.as_py()
                if text:
                    spans = base_spans(text) + confirmed_spans(text)
                    text = mask(text, spans) if spans else text
                texts.append(text)
            yield batch.set_column(at, batch.schema.names[at], pa.array(texts, pa.string()))

    masked = documents.mapInArrow(run, documents.schema)
    if length_col in columns:
        number = documents.schema[length_col].dataType
        changed = F.char_length(text_col).cast(number)
        same = F.when(F.col(text_col).isNull(), F.col(length_col)).otherwise(changed)
        masked = masked.withColumn(length_col, same)
    return masked.select(*columns)
