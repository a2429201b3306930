"""Secret scans: fixed patterns, and strings that a token vocabulary compresses badly.

Base spans come from three patterns: assignments to a name such as ``password``, access keys, and long runs of hex
digits. The token-efficiency test adds spans of kind ``token``: a run of key characters of at least ``least`` is random
if it has few characters per token under a public byte-level vocabulary (written words have about four, random letters
and digits about one and a half). Before the test, known digests (hex of the usual digest sizes), identifiers (UUIDs,
numbers, runs without digits or with words parted by marks or capitals) and whatever overlaps a base span are left out.

Spans are offsets in code points, end exclusive, of the whole match; they are sorted by start, then kind. Null and empty
texts have none. Every row gives one row; repeated rows are scanned alike; columns but key and text are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import frugal, per_worker

KINDS = ("assign", "access", "hex", "token")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
# Greedy runs: at least so many characters in the pattern is the same as dropping shorter matches.
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
RUN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
DIGESTS = {32, 40, 56, 64, 96, 128}  # hex digits of MD5, SHA-1, SHA-224, SHA-256, SHA-384 and SHA-512
ALL_HEX = re.compile(r"(?:[0-9a-f]+|[0-9A-F]+)\Z")
UUID = re.compile(r"[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}\Z")
WORDS = re.compile(r"[A-Z]?[a-z]{3,}|(?<![A-Za-z0-9])[A-Z]{4,}(?![A-Za-z0-9])")
RATIO = 2.2


def identifier(text: str) -> bool:
    """Digests, UUIDs, numbers, and names made of words."""
    if UUID.match(text) or (len(text) in DIGESTS and ALL_HEX.match(text)):
        return True
    digits = sum(c.isdigit() for c in text)
    letters = sum(c.isalpha() for c in text)
    if not digits or not letters:
        return True
    # Names consist of words: small letters after one capital at most, or capitals between marks.
    return 2 * sum(len(w) for w in WORDS.findall(text)) > len(text)


def scan(text: str, encode, ratio: float = RATIO) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the secrets of one text; ``encode`` gives a string's tokens."""
    found = []
    lowered = text.lower()
    if any(n in lowered for n in NAMES):
        found += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text)]
    found += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    base = list(found)
    for m in RUN.finditer(text):
        run = m[0]
        if identifier(run) or any(s < m.end() and m.start() < e for _, s, e in base):
            continue
        if len(run) < ratio * len(encode(run)):
            found.append(("token", m.start(), m.end()))
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0])))


def _encoder(vocabulary: bytes, pattern: str):
    import base64

    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def secrets(docs: DataFrame, vocabulary: str, pattern: str, key: str = "doc_id", redacted: bool = False, carried: tuple[str, ...] = ()) -> DataFrame:
    """Rows (key, spans): an array of struct(kind, start, end); with ``redacted`` also the text with spans blotted out.

    ``carried`` columns come along unchanged.
    """
    with open(vocabulary, "rb") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())  # one vocabulary file, well under 10 MB
    spans = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = per_worker(("secrets", vocabulary), lambda: _encoder(shared.value, pattern))
        for batch in batches:
            texts = batch.column(1).to_pylist()
            found = [scan(t, encode) if t else [] for t in texts]
            columns = [batch.column(0), pa.array([[dict(zip(("kind", "start", "end"), s)) for s in f] for f in found], spans)]
            if redacted:
                columns.append(pa.array([blotted(t, f) if f else t for t, f in zip(texts, found)], pa.string()))
            yield pa.RecordBatch.from_arrays([*columns, *batch.columns[2:]], names=[key, "spans", *["redacted"] * redacted, *carried])

    rows = docs.select(key, "text", *carried)
    kept = "".join(f", {c} {rows.schema[c].dataType.simpleString()}" for c in carried)
    return rows.mapInArrow(frugal(make, ("secrets", vocabulary)), f"{key} {rows.schema[key].dataType.simpleString()}, spans array<struct<kind: string, start: int, end: int>>" + ", redacted string" * redacted + kept)


def blotted(text: str, spans: list[tuple[str, int, int]], mark: str = "[secret]") -> str:
    """The text with every span, or overlapping spans together, replaced by the mark."""
    out, at = [], 0
    for _, start, end in spans:
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])


def listed(spans: Column) -> Column:
    """kind:start:end of the spans in order, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
