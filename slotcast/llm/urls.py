"""URL filters by a sorted digest array.

Each rule is a host and a path: it fits the host and its subdomains where the url's path starts with the rule's. Rules
are kept as one file: 64-bit xxhash keys of host + path in ascending order, beside them the full strings. Tasks map the
file into memory, look up all keys that a batch of urls could match (domain suffixes and paths as long as a rule's) by one vectorised binary search, and confirm hits on the stored strings, so equal keys of different strings do no
harm. The longest fitting rule decides (host and path together; at equal length the longer host).

A url's host is what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; its path goes on
up to ``?``, ``#`` or the end. Null urls and urls without ``://`` have empty ones. What no rule fits is allowed. Every
row gives one row, repeated ones too; columns but key and url are not read. Rules must be unique.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

PARTS = re.compile(r"([^/?#]*)([^?#]*)")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(url: str | None) -> tuple[str, str]:
    """Host and path."""
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    m = PARTS.match(rest)
    return m[1].translate(LOWER), m[2]


class Rules:
    """Sorted keys, full strings and verdicts, in one mapped file."""

    def __init__(self, path: str):
        self.file = np.memmap(path, np.uint8, "r")
        count, lengths, hosts = np.frombuffer(self.file[:24], np.int64)
        at = 24
        self.keys = self.file[at : (at := at + 8 * count)].view(np.uint64)
        self.ends = self.file[at : (at := at + 8 * count)].view(np.int64)
        self.lengths = self.file[at : (at := at + 8 * lengths)].view(np.int64)
        self.host_lengths = self.file[at : (at := at + 8 * hosts)].view(np.int64)
        self.blocks = self.file[at : (at := at + count)]
        self.strings = self.file[at:]

    @staticmethod
    def write(rules: list[tuple[str, str, str]], path: str, digest) -> None:
        """``rules``: (verdict, host, path)."""
        rows = sorted((digest((h + p).encode()), (h + p).encode(), v == "block") for v, h, p in rules)
        lengths, hosts = sorted({len(p) for _, _, p in rules}), sorted({len(h) for _, h, _ in rules})
        with open(path, "wb") as out:
            out.write(np.array([len(rows), len(lengths), len(hosts)], np.int64).tobytes())
            out.write(np.array([r[0] for r in rows], np.uint64).tobytes())
            out.write(np.cumsum([len(r[1]) for r in rows], dtype=np.int64).tobytes())
            out.write(np.array(lengths, np.int64).tobytes())
            out.write(np.array(hosts, np.int64).tobytes())
            out.write(bytes(r[2] for r in rows) + b"".join(r[1] for r in rows))

    def string(self, at: int) -> bytes:
        start = int(self.ends[at - 1]) if at else 0
        return self.strings[start : int(self.ends[at])].tobytes()

    def judge(self, parts: list[tuple[str, str]], digest) -> list[tuple[str | None, str]]:
        """(rule, verdict) of each host and path."""
        owner, tries = [], []
        lengths, host_lengths = self.lengths.tolist(), self.host_lengths.tolist()
        for i, (host, path) in enumerate(parts):
            heads = [path[:n] for n in lengths if n <= len(path)]
            for n in host_lengths:
                if n == len(host) or (0 < n < len(host) and host[-n - 1] == "."):
                    for head in heads:
                        owner.append(i)
                        tries.append((host[len(host) - n :] + head, n))
        keys = np.fromiter((digest(t.encode()) for t, _ in tries), np.uint64, len(tries))
        low, high = np.searchsorted(self.keys, keys, "left"), np.searchsorted(self.keys, keys, "right")
        best: dict[int, tuple] = {}
        for k in np.flatnonzero(high > low).tolist():
            text, host_length = tries[k]
            for at in range(int(low[k]), int(high[k])):
                if self.string(at) == text.encode():
                    best[owner[k]] = max(best.get(owner[k], (0,)), (len(text), host_length, text, "block" if self.blocks[at] else "allow"))
        return [best[i][2:] if i in best else (None, "allow") for i in range(len(parts))]


def judged(pages: DataFrame, rules: list[tuple[str, str, str]], key: str = "page_id", digest=None) -> DataFrame:
    """Rows (key, host, path, rule, verdict) of each url. ``rules``: (allow or block, host, path)."""
    import xxhash

    digest = digest or xxhash.xxh64_intdigest
    name = shipped(pages.sparkSession, rules, digest)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import SparkFiles

        held = Rules(SparkFiles.get(name))
        for batch in batches:
            parts = [split(u) for u in batch.column(1).to_pylist()]
            said = held.judge(parts, digest)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.string()) for c in ([p[0] for p in parts], [p[1] for p in parts], [s[0] for s in said], [s[1] for s in said]))],
                names=[key, "host", "path", "rule", "verdict"],
            )

    rows = pages.select(key, "url")
    return rows.mapInArrow(make, f"{key} {rows.schema[key].dataType.simpleString()}, host string, path string, rule string, verdict string")


def shipped(spark: SparkSession, rules: list[tuple[str, str, str]], digest) -> str:
    """Writes the rule file on the driver and has Spark bring it to every executor; returns its name."""
    name = f"rules-{uuid.uuid4().hex}.bin"
    path = os.path.join(tempfile.mkdtemp(prefix="slotcast-rules-"), name)
    Rules.write(rules, path, digest)
    spark.sparkContext.addFile(path)
    return name
