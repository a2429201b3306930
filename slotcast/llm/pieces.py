"""SentencePiece encoding and decoding for merge-type (BPE) models.

Encoding keeps a prefix table: for every prefix of a run of text, the last token of its encoding. That token is unique:
among the vocabulary's matches that end at the position (an Aho-Corasick automaton lists them) it is the one that
encodes to itself and whose pair with the last token of the prefix before it encodes to just these two. Ids are read
backwards from the table, so time is linear in the text, and a merge list is only run on single pairs, which are kept.

Texts are cut before each run of spaces, which no piece of such a model crosses, and between characters that no piece
holds side by side; the ids of short parts are kept in a bounded table of each worker.
Null is encoded as an empty text; empty texts give the begin and end ids only. Characters outside the vocabulary become
their UTF-8 byte pieces. Rows keep their number and order, repeated rows included; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import frugal, per_worker

SPACE = "▁"
RUNS = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
RAW = 1 << 24  # ids from here on stand for single characters outside the vocabulary
KEPT_RUNS, KEPT_LENGTH, KEPT_PAIRS = 400_000, 48, 2_000_000


class Pieces:
    """Encoder and decoder over the pieces of one model file's bytes."""

    def __init__(self, model: bytes):
        import ahocorasick
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        sp = self.library
        self.begin, self.end = sp.bos_id(), sp.eos_id()
        self.byte_ids = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.text, self.score = {}, {}
        automaton = ahocorasick.Automaton()
        chunks = []
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                chunks.append(bytes([int(piece[3:5], 16)]))
            elif sp.is_control(i):
                chunks.append(b"")
            elif sp.is_unknown(i):
                chunks.append(" ⁇ ".encode())
            else:
                chunks.append(piece.replace(SPACE, " ").encode())
                if not sp.is_unused(i):
                    self.text[i] = piece
                    automaton.add_word(piece, (i, len(piece)))
        automaton.make_automaton()
        self.automaton = automaton
        self.ids = {p: i for i, p in self.text.items()}
        if any(SPACE in p.lstrip(SPACE) for p in self.ids):
            raise ValueError("a piece goes past a space: runs of text can't be encoded apart")
        self.score = {p: sp.get_score(i) for p, i in self.ids.items()}
        self.singles = {p for p in self.ids if len(p) == 1}
        self.inside = {p[i : i + 2] for p in self.ids for i in range(len(p) - 1)}
        self.length = {i: len(p) for i, p in self.text.items()}
        self.size = np.array([len(c) for c in chunks])
        self.start = np.concatenate(([0], np.cumsum(self.size)))[:-1]
        self.bytes = np.frombuffer(b"".join(chunks), np.uint8)
        self.runs: dict[str, bytes] = {}
        self.pairs: dict[int, bool] = {}
        self.alone = {i: self._merged(p) == [p] for i, p in self.text.items() if len(p) > 1}
        self.alone |= {self.ids[p]: True for p in self.singles}

    def _merged(self, text: str) -> list[str]:
        """Plain merging of a short text: best score first, then leftmost."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.score.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def _fits(self, left: int, right: int) -> bool:
        """Whether the two tokens' texts together encode to just the two."""
        a = chr(left - RAW) if left >= RAW else self.text[left]
        b = self.text[right]
        return self._merged(a + b) == [a, b]

    def run(self, text: str) -> list[int]:
        """Token ids of one run without begin and end."""
        last = [0] * (len(text) + 1)
        if not self.singles.issuperset(text):
            for p, c in enumerate(text):
                if c not in self.singles:
                    last[p + 1] = RAW + ord(c)
        pairs, alone = self.pairs, self.alone
        for end, (token, length) in self.automaton.iter(text):
            if last[end + 1]:
                continue
            before = end + 1 - length
            if before:
                left = last[before]
                key = left << 24 | token
                good = pairs.get(key)
                if good is None:
                    if len(pairs) > KEPT_PAIRS:
                        pairs.clear()
                    good = pairs[key] = self._fits(left, token)
            else:
                good = alone[token]
            if good:
                last[end + 1] = token
        found, p = [], len(text)
        while p:
            token = last[p]
            if token >= RAW:
                found += [self.byte_ids[b] for b in reversed(chr(token - RAW).encode())]
                p -= 1
            else:
                found.append(token)
                p -= self.length[token]
        found.reverse()
        return found

    def _cut(self, run: str) -> list[str]:
        """Parts of a run that no piece joins: cut between characters that stand together in no piece."""
        inside = self.inside
        parts, start = [], 0
        for i in range(1, len(run)):
            if run[i - 1 : i + 1] not in inside:
                parts.append(run[start:i])
                start = i
        parts.append(run[start:])
        return parts

    def _ids(self, run: str) -> bytes:
        """Ids of a run not met before, kept if it is short."""
        kept = self.runs
        if len(kept) >= KEPT_RUNS:
            kept.clear()
        out = []
        for part in self._cut(run):
            ids = kept.get(part)
            if ids is None:
                ids = np.array(self.run(part), "<u4").tobytes()
                if len(part) <= KEPT_LENGTH:
                    kept[part] = ids
            out.append(ids)
        return b"".join(out)

    def encode(self, text: str) -> bytes:
        """Ids with begin and end, as little-endian unsigned 32-bit integers."""
        if not text:
            return np.array([self.begin, self.end], "<u4").tobytes()
        runs, kept = RUNS.findall(SPACE + text.replace(" ", SPACE)), self.runs
        out = [np.array([self.begin], "<u4").tobytes()]
        for r in runs:
            out.append(kept.get(r) or self._ids(r))
        out.append(np.array([self.end], "<u4").tobytes())
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        """Text of ids; what isn't UTF-8 after byte pieces is left to the library's own replacement."""
        tokens = np.frombuffer(ids, "<u4")
        if not len(tokens):
            return ""
        size = self.size[tokens]
        ends = np.cumsum(size)
        raw = self.bytes[np.repeat(self.start[tokens] - ends + size, size) + np.arange(ends[-1])].tobytes()
        first = next((t for t in tokens[:64].tolist() if t not in (self.begin, self.end)), -1)
        try:
            text = raw.decode()
        except UnicodeDecodeError:
            return self.library.decode(tokens.tolist())
        return text[1:] if self.text.get(first, "").startswith(SPACE) else text


def model_bytes(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def encode(docs: DataFrame, model: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (key, ids, decoded): ids as little-endian unsigned 32-bit integers, and the text that they decode to."""
    shared = docs.sparkSession.sparkContext.broadcast(model_bytes(model))  # one model file, well under 10 MB

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = per_worker(("pieces", model), lambda: Pieces(shared.value))
        for batch in batches:
            ids = [pieces.encode(t or "") for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary()), pa.array([pieces.decode(i) for i in ids], pa.string())], names=[key, "ids", "decoded"])

    rows = docs.select(F.col(key), F.col(text).alias("text"))
    return rows.mapInArrow(frugal(make, ("pieces", model)), f"{key} {rows.schema[key].dataType.simpleString()}, ids binary, decoded string")
