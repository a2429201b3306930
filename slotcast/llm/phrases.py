"""Phrase collocation mining by dynamic itemset counting.

Texts are lower-cased (A-Z) and split at ``. , ; : ! ?`` and line ends into pieces, pieces at blanks and tabs into words.
A phrase of one language (null: ``und``) is a run of up to ``longest`` words inside a piece.

Counting. Documents are dealt into ``shards`` once. Step s scans shard s modulo ``shards``. Words are counted from step 0
on. A longer phrase is active from the step after both its subphrases (without its last, without its first word) have
reached the threshold, and is counted for one full cycle, so lengths interleave in one scan. Steps go on until every
active phrase has its cycle. Tasks count phrases under 64-bit keys and ask a table of fixed size (``SLOTS``, a set of
steps each) when the subphrases turned frequent. Phrases that share a slot may be counted in a shard too early or too
late, which changes nothing: a phrase's count in a shard is whole or missing, is kept by shard, and the frequent ones all
get their full cycle. Counts so far never exceed true counts, so nothing is activated wrongly.

A phrase whose cycle is over and that stayed below the threshold is let go at once: tasks hand on with each phrase the
last step in which its cycle can have begun.

Words of the frequent phrases. Further steps, over a ``PARTS``-th of the documents each, give the frequent keys their texts:
a task hands on each once, and later steps look only for those that have none yet.

Keys have 55 bits of hash: a frequent phrase shares its key with some other of a billion phrases of its length with a
chance of 3 in 10^8, and its count would then hold the other's too.

Scores and the dropping of phrases inside longer ones are joins and windows over the frequent phrases, in exact decimals.

Null and empty texts hold no word. Repeated rows count again; rows without an id count too. Empty tables give no rows.
Columns besides text and lang are not read.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..session import ensure_checkpoint_dir
from .common import WordHasher, bytes_of, grams, mixed, slices, stored

LEAST, LONGEST, SHARDS, PARTS = 30, 4, 2, 8
SLOTS = 1 << 23  # entries of a table of frequent phrases; each phrase sets two
HELD = 1 << 22  # keys a task holds before it counts them
BREAKS = b".,;:!?\n\x0b\x0c\r"
_BREAK = np.zeros(256, bool)
_BREAK[list(BREAKS)] = True
_LOWER = bytes(b + 32 if 65 <= b <= 90 else 32 if b == 9 else b for b in range(256))
# A key's low bits: the phrase's length above the last step in which its cycle can have begun.
STEP_BITS, LENGTH_BITS = 6, 3
KEYS = "key long, c long"


class Texts:
    """Word hashes of a batch's rows, the piece each word stands in, and a number for its language."""

    def __init__(self):
        self.hasher = WordHasher(lower=True, seed=13)
        self.hasher.space[:] = _BREAK
        self.hasher.space[[9, 32]] = True

    def runs(self, lang: pa.Array, text: pa.Array) -> Iterator[tuple]:
        """For rows of about a megabyte together: bytes, words, their places, their pieces, their languages' hashes."""
        data, offsets = bytes_of(text)
        names = lang.dictionary_encode()
        codes = names.indices.to_numpy()
        seeds = np.array([name_hash(x) for x in names.dictionary.to_pylist()], np.uint64)
        for low, high in slices(offsets):
            own = offsets[low : high + 1]
            words, at = self.hasher.words_at(data, own)
            part = data[own[0] : own[-1]]
            # A row's start is a break as well.
            breaks = np.sort(np.concatenate((np.flatnonzero(_BREAK[part]) + own[0], own[:-1])))
            row = np.searchsorted(own, at, "right") - 1 + low
            yield data, words, at, np.searchsorted(breaks, at, "right"), seeds[codes[row]], row, own


def name_hash(name: str) -> int:
    """64-bit hash of a language's name."""
    return int.from_bytes(hashlib.sha256(name.encode()).digest()[:8], "little")


def keys_of(words: np.ndarray, piece: np.ndarray, seed: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the runs of n words from each word on, and which of these runs lie in one piece."""
    if len(words) < n:
        return np.zeros(0, np.uint64), np.zeros(0, bool)
    inside = piece[n - 1 :] == piece[: len(piece) - n + 1]
    bits = np.uint64(STEP_BITS + LENGTH_BITS)
    return (mixed(grams(words, n) ^ seed[: len(words) - n + 1]) >> bits << bits) | np.uint64(n << STEP_BITS), inside


def length_of(key):
    return F.shiftright(key, STEP_BITS).bitwiseAND(F.lit((1 << LENGTH_BITS) - 1)).cast("int")


def slots(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two entries of keys in a table."""
    bits = SLOTS.bit_length() - 1
    return tuple((keys << np.uint64(skip) >> np.uint64(64 - bits)).astype(np.int64) for skip in (0, bits))


def marks(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """What both entries of a key have in common: all that was set for it, and rarely more."""
    one, two = slots(keys)
    return table[one] & table[two]


def _table(rows: DataFrame, bits, width: int) -> np.ndarray:
    """Table of the keys in ``rows`` with ``bits`` (below 2 ** width) set for each; at most ``SLOTS`` rows are fetched."""
    places = [F.shiftrightunsigned(F.shiftleft("key", skip), 65 - SLOTS.bit_length()) for skip in (0, SLOTS.bit_length() - 1)]
    found = rows.select(F.explode(F.array(*places)).alias("slot"), bits.alias("bits")).groupBy("slot").agg(F.bit_or("bits").alias("bits")).toArrow()
    kind = next(k for k in (np.uint8, np.uint16, np.uint32, np.uint64) if width <= 8 * np.dtype(k).itemsize)
    out = np.zeros(SLOTS, kind)
    out[found["slot"].to_numpy()] = found["bits"].to_numpy()
    return out


def _due(hot: np.ndarray, prefix: np.ndarray, suffix: np.ndarray, step: int, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """Phrases to be counted in ``step``, by the steps in which their subphrases may have turned frequent.

    Also the last step in which a phrase's cycle can have begun; it is counted from there for a cycle in any case.
    """
    past = np.uint64((1 << step) - 1)
    a, b = marks(hot, prefix).astype(np.uint64) & past, marks(hot, suffix).astype(np.uint64) & past
    either = a | b
    begun = np.zeros(len(a), np.uint64)
    for s in range(step):
        begun[(either >> np.uint64(s)) & np.uint64(1) == 1] = s + 1
    return (a != 0) & (b != 0) & (begun + np.uint64(shards) > step), begun


def _packed(table: np.ndarray) -> tuple[bytes, str]:
    """A table with few entries set takes little room on its way to the tasks."""
    return zlib.compress(table.tobytes(), 1), table.dtype.str


def _unpacked(packed: tuple[bytes, str]) -> np.ndarray:
    return np.frombuffer(zlib.decompress(packed[0]), packed[1])


def _counts(shard: DataFrame, step: int, lengths: list[int], hot: dict[int, tuple[bytes, str]], shards: int) -> DataFrame:
    """Rows of ``KEYS``: partial counts in a shard of the phrases of ``lengths`` that are due in ``step``."""
    shared = shard.sparkSession.sparkContext.broadcast({k: v for k, v in hot.items() if k + 1 in lengths})  # of fixed size

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, texts = {k: _unpacked(v) for k, v in shared.value.items()}, Texts()
        waiting: list[np.ndarray] = []
        held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            keys, counts = np.unique(np.concatenate(waiting or [np.zeros(0, np.uint64)]), return_counts=True)
            waiting.clear()
            for low in range(0, len(keys), 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(keys[low : low + (1 << 16)].view(np.int64)), pa.array(counts[low : low + (1 << 16)])], names=["key", "c"])

        for batch in batches:
            for _, words, _, piece, seed, _, _ in texts.runs(batch.column(0), batch.column(1)):
                shorter = None
                for n in range(min(lengths) - (min(lengths) > 1), max(lengths) + 1):
                    keys, inside = keys_of(words, piece, seed, n)
                    if n in lengths and len(keys):
                        if n > 1:
                            due, begun = _due(tables[n - 1], shorter[:-1], shorter[1:], step, shards)
                            inside = inside & due
                            waiting.append(keys[inside] | begun[inside])
                        else:
                            waiting.append(keys[inside])
                        held += len(waiting[-1])
                    shorter = keys
                if held >= HELD:
                    yield from flush()
                    held = 0
        yield from flush()

    return shard.mapInArrow(make, KEYS)


def frequent(sharded: list[DataFrame], least: int, longest: int) -> dict[int, DataFrame]:
    """Keys of the phrases that occur ``least`` times, by length: rows with ``hot`` of (key, act, c0, c1, ..., hot)."""
    shards = len(sharded)
    if shards * longest > 62 or longest >= 1 << LENGTH_BITS:
        raise ValueError("steps are kept as bits: at most 62 / longest shards, and phrases of at most 7 words")
    per_shard = [f"c{j}" for j in range(shards)]
    total = sum((F.col(c) for c in per_shard), F.lit(0).cast("long"))
    state: dict[int, DataFrame] = {}
    hot: dict[int, tuple[bytes, str]] = {}
    steps: dict[int, list[int]] = {}  # steps in which phrases of a length turned frequent
    step = 0
    while True:
        lengths = [1] if step < shards else []
        lengths += [n for n in range(2, longest + 1) if any(step - shards <= h < step for h in steps.get(n - 1, []))]
        if not lengths:
            return state
        new = _counts(sharded[step % shards], step, lengths, hot, shards)
        steps_mask = (1 << STEP_BITS) - 1
        key, act = F.col("key").bitwiseAND(F.lit(~steps_mask)), F.col("key").bitwiseAND(F.lit(steps_mask)).cast("int")
        rows = new.select(key.alias("key"), act.alias("act"), *(F.lit(0).cast("long").alias(c) for c in per_shard), F.lit(None).cast("int").alias("hot"), "c")
        for n in lengths:
            if n in state:
                rows = rows.unionByName(state[n].withColumn("c", F.lit(0).cast("long")))
        summed = rows.groupBy("key").agg(F.min("act").alias("act"), *(F.max(c).alias(c) for c in per_shard), F.min("hot").alias("hot"), F.sum("c").alias("c"))
        now = per_shard[step % shards]
        summed = summed.withColumn(now, F.greatest(now, "c")).drop("c")  # a shard's count is whole or missing
        summed = summed.withColumn("hot", F.coalesce("hot", F.when(total >= least, F.lit(step))))
        merged = stored(summed.where(F.col("hot").isNotNull() | (F.col("act") + shards - 1 > step)))
        for n in lengths:
            state[n] = merged.where(length_of("key") == n)
        for r in merged.where("hot is not null").groupBy(length_of("key").alias("n")).agg(F.collect_set("hot").alias("steps")).collect():  # a row per length
            steps[r["n"]] = sorted(r["steps"])
        for n in lengths:
            if n < longest:
                hot[n] = _packed(_table(state[n].where("hot is not null"), F.expr("shiftleft(1L, hot)"), longest * shards))
        step += 1


def _named(docs: DataFrame, frequent_ones: np.ndarray, unnamed: np.ndarray, longest: int) -> DataFrame:
    """Rows (lang, n, key, phrase, c): texts of the unnamed ones of the frequent phrases, once per task.

    Rows of n = 0 hold numbers of words.
    """
    shared = docs.sparkSession.sparkContext.broadcast((_packed(frequent_ones), _packed(unnamed)))  # of fixed size

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (known, wanted), texts = map(_unpacked, shared.value), Texts()
        met: set[int] = set()
        for batch in batches:
            langs = batch.column(0).to_pylist()
            for data, words, at, piece, seed, row, own in texts.runs(batch.column(0), batch.column(1)):
                lower = bytes(data[own[0] : own[-1]]).translate(_LOWER)
                ends = np.append(at[1:], own[-1]) - own[0]
                starts = at - own[0]
                out = [(langs[i], 0, 0, b"", int(c)) for i, c in zip(*np.unique(row, return_counts=True))]
                if len(met) > HELD:
                    met.clear()
                shorter = None
                for n in range(1, longest + 1):
                    keys, inside = keys_of(words, piece, seed, n)
                    good = inside & (marks(known, keys) >> np.uint8(n) & 1 == 1)
                    if n > 1 and len(keys):  # parts of a frequent phrase are frequent
                        good &= shorter[:-1] & shorter[1:]
                    shorter, places = good, np.flatnonzero(good)
                    places = places[marks(wanted, keys[places]) >> np.uint8(n) & 1 == 1]
                    distinct, first = np.unique(keys[places], return_index=True)
                    for key, i in zip(distinct.view(np.int64).tolist(), places[first].tolist()):
                        if key not in met:
                            met.add(key)
                            # from the first word's start to the next word's start; the last word ends where its piece does
                            out.append((langs[row[i]], n, key, b" ".join(_words(lower[starts[i] : ends[i + n - 1]], n)), 0))
                columns = list(zip(*out)) if out else [[]] * 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.binary()).cast(pa.string()), pa.array(columns[4], pa.int64())],
                    names=["lang", "n", "key", "phrase", "c"],
                )

    return docs.mapInArrow(make, "lang string, n int, key long, phrase string, c long")


_TO_BLANK = bytes(32 if b in BREAKS else b for b in range(256))


def _words(text: bytes, n: int) -> list[bytes]:
    """The first n words of a text; only blanks (tabs are blanks by now) and breaks part words."""
    return [w for w in text.translate(_TO_BLANK).split(b" ") if w][:n]


def counted(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, shards: int = SHARDS) -> tuple[DataFrame, DataFrame]:
    """The phrases of up to ``longest`` words that occur ``least`` times (lang, n, phrase, f), and each language's number of words."""
    spark = docs.sparkSession
    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text").where("text is not null")
    path = f"{ensure_checkpoint_dir(spark)}/llm-{uuid.uuid4().hex}"
    place = F.monotonically_increasing_id() % (PARTS * shards)
    rows.withColumn("part", place).write.partitionBy("part").option("compression", "zstd").parquet(path)
    whole = spark.read.schema("lang string, text string, part int").parquet(path)
    sharded = [whole.where(F.col("part") % shards == j).select("lang", "text") for j in range(shards)]
    state = frequent(sharded, least, longest)
    found = None
    for part in state.values():
        part = part.where("hot is not null").select(length_of("key").alias("n"), "key", sum((F.col(f"c{j}") for j in range(shards)), F.lit(0).cast("long")).alias("f"))
        found = part if found is None else found.unionByName(part)
    found = stored(found)
    left, named, all_of_them = found, None, None
    for part in range(PARTS):
        table = _table(left, F.expr("shiftleft(1L, n)"), longest + 1)
        all_of_them = table if all_of_them is None else all_of_them
        some = _named(whole.where(F.floor(F.col("part") / shards) == part).select("lang", "text"), all_of_them, table, longest)
        some = stored(some.groupBy("n", "key", "lang").agg(F.min("phrase").alias("phrase"), F.sum("c").alias("words")))
        named = some if named is None else named.unionByName(some)
        left = stored(left.join(some.select("key"), "key", "left_anti"))
    once = named.where("n > 0").groupBy("key").agg(F.min_by("lang", "phrase").alias("lang"), F.min("phrase").alias("phrase"))
    phrases = stored(once.join(found, "key").select("lang", "n", "phrase", "f"))
    return phrases, named.where("n = 0").groupBy("lang").agg(F.sum("words").alias("n"))


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, shards: int = SHARDS, inside: int = 80, top: int | None = None) -> DataFrame:
    """Phrases with their scores: lang, rank, phrase, a, l, r, n, score; the first ``top`` of each language, or all.

    A phrase of a occurrences, cut into parts of l and r, scores floor(2000000 a / (l + r)) at its lowest-scoring cut (the
    first of equals). It is dropped if its words lie inside a longer one that has ``inside`` hundredths of its occurrences.
    """
    phrases, totals = counted(docs, least, longest, shards)
    long = phrases.where("n > 1").select("lang", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("words"))
    part = lambda a, b: F.array_join(F.slice("words", a, b), " ")
    size = F.size("words")
    cut = long.withColumn("k", F.explode(F.sequence(F.lit(1), size - 1)))
    cut = cut.select("lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("left"), part(F.col("k") + 1, size - F.col("k")).alias("right"))
    f = lambda side, name: phrases.select("lang", F.col("phrase").alias(side), F.col("f").alias(name))
    # parts of a frequent phrase are frequent, so both joins find their row
    scored = cut.join(f("left", "l"), ["lang", "left"]).join(f("right", "r"), ["lang", "right"])
    exact = F.expr("cast(2000000 as decimal(10, 0)) * cast(a as decimal(20, 0)) div (cast(l as decimal(20, 0)) + cast(r as decimal(20, 0)))")
    lowest = scored.withColumn("score", exact).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("x"))
    spans = F.flatten(F.transform(F.sequence(F.lit(2), size - 1), lambda m: F.transform(F.sequence(F.lit(1), size - m + 1), lambda i: F.array_join(F.slice("words", i, m), " "))))
    holders = long.where(size > 2).select("lang", F.col("a").alias("longer"), F.explode(spans).alias("phrase")).groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = lowest.join(holders, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (F.col("longer").cast("decimal(20,0)") * 100 < F.col("a").cast("decimal(20,0)") * inside))
    ranked = kept.select("lang", "phrase", "a", "x.l", "x.r", "x.score").join(totals, "lang")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = ranked.withColumn("rank", F.row_number().over(order).cast("long"))
    return (ranked if top is None else ranked.where(F.col("rank") <= top)).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
