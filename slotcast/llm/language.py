"""Language identification: averaged hashed subword embeddings under a linear softmax.

A text's subwords are the runs of 1 to 4 characters inside its words, a blank marking a word's start and end. Each is
hashed to a row of an embedding table; a text is the mean of its subwords' rows, scored by a linear softmax. Table and
softmax are trained together by stochastic gradient descent in numpy on the driver, on a bounded, documented sample of
labelled rows (``per_language`` texts of each language by a hash of the id, at most ``languages`` languages, the most
frequent ones); a fifth of it calibrates the temperature and gives the rejection thresholds. Applying needs one small
table (bucket x 2 per language) and no shuffle.

Null texts and texts without a letter get ``und`` with score 0. A text is rejected if it is ``und``, if its calibrated
probability is below half of the score that all but one in a thousand of the calibration texts reach, or if its subwords
are too unusual for the language it is given: their mean log frequency among that language's training texts lies further
below the median of its calibration texts than ``WIDTH`` times what 99 in 100 calibration texts keep to. The last test
acts for any number of languages, one included; short texts get more room. Without calibration texts it rejects nothing.
Rows with a null language don't train. Without any labelled row everything is ``und``. Ties go to the language that
sorts first. Repeated rows are scored alike; columns other than key and text are not read when scoring.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import frugal, mixed, per_worker

BITS, SIZE, SEED = 16, 16, 7
LENGTHS = (1, 2, 3, 4)
PIECE = 1 << 18  # characters turned into arrays at a time
UNKNOWN = "und"
# Share of a language's subwords taken as spread over all buckets; distance allowed, in 99% quantiles and at least in nats.
UNSEEN, WIDTH, LEAST_WIDTH = 0.05, 2.0, 0.5


def _letters() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)


def _pieces(codes: np.ndarray, letters: np.ndarray) -> Iterator[np.ndarray]:
    """Code points with every run of others replaced by a blank, in pieces that end at a blank."""
    start = 0
    while start < len(codes):
        end = min(start + PIECE, len(codes))
        if end < len(codes):
            gap = np.flatnonzero(~letters[codes[start:end]])
            if len(gap):
                end = start + int(gap[-1]) + 1
        part = codes[start:end]
        yield np.concatenate(([32], np.where(letters[part], part, 32), [32])).astype(np.uint64)
        start = end


def subwords(codes: np.ndarray) -> np.ndarray:
    """Buckets of the subwords of a blank-separated run of code points."""
    out = []
    blank = codes == 32
    for n in LENGTHS:
        count = len(codes) - n + 1
        if count <= 0:
            continue
        h = np.full(count, n, np.uint64)
        for i in range(n):
            h = h * np.uint64(1_000_003) + codes[i : i + count]
        inner = np.zeros(count, bool)  # a blank inside, or nothing but a blank
        for i in range(n):
            if 0 < i < n - 1 or n < 3:
                inner |= blank[i : i + count]
        out.append((mixed(h[~inner]) >> np.uint64(64 - BITS)).astype(np.int64))
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def bag(text: str, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct subword buckets of a text and how often each occurs."""
    counts = np.zeros(1 << BITS, np.int64)
    for piece in _pieces(_codes(text), letters):
        counts += np.bincount(subwords(piece), minlength=1 << BITS)
    ids = np.flatnonzero(counts)
    return ids, counts[ids]


class Model:
    """Bucket scores and log frequencies per language, the temperature and the rejection thresholds.

    ``usual`` is the median of a language's mean log frequencies, ``width`` how far below it a long text may lie.
    """

    def __init__(self, languages: list[str], table: np.ndarray, bias: np.ndarray, temperature: float, threshold: float, usual: np.ndarray, width: float = np.inf):
        self.languages, self.table, self.bias = languages, table, bias
        self.temperature, self.threshold = temperature, threshold
        self.usual, self.width = usual, width

    def score(self, texts: list[str | None], letters: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, calibrated probability and rejection of each text; long texts are summed piece by piece."""
        names, probabilities, rejected = [], np.zeros(len(texts)), np.ones(len(texts), bool)
        for at, text in enumerate(texts):
            total, count, any_letter = np.zeros(self.table.shape[1]), 0, False
            for piece in _pieces(_codes(text or ""), letters):
                any_letter = any_letter or bool((piece != 32).any())
                buckets = subwords(piece)
                total += self.table[buckets].sum(axis=0, dtype=np.float64)
                count += len(buckets)
            if not any_letter or not self.languages:
                names.append(UNKNOWN)
                continue
            scores, frequency = np.split(total / max(count, 1), 2)
            logits = (scores + self.bias) / self.temperature
            p = np.exp(logits - logits.max())
            p /= p.sum()
            best = int(p.argmax())
            names.append(self.languages[best])
            probabilities[at] = min(1.0, round(float(p[best]), 6))
            rejected[at] = probabilities[at] < self.threshold or self.usual[best] - frequency[best] > self.width * room(count)
        return names, probabilities, rejected


def room(count: np.ndarray | int) -> np.ndarray:
    """Factor of the distance allowed to a text of so many subwords."""
    return 1 + 4 / np.sqrt(np.maximum(count, 1))


def train(bags: list[tuple[np.ndarray, np.ndarray]], labels: list[str], rounds: int = 12, rate: float = 0.5) -> Model:
    """Fits a model on (buckets, counts) of each text; every fifth text calibrates it."""
    languages = sorted(set(labels))
    if not languages:
        return Model([], np.zeros((1 << BITS, 0)), np.zeros(0), 1.0, 0.0, np.zeros(0))
    lengths = np.array([counts.sum() for _, counts in bags])
    share_of = lambda i: bags[i][1] / max(lengths[i], 1)  # noqa: E731  made when needed: a table of doubles for all bags is several times their size
    target = np.array([languages.index(x) for x in labels])
    usable = np.array([len(b[0]) > 0 for b in bags], bool)
    held = np.arange(len(bags)) % 5 == 4
    fit, check = np.flatnonzero(usable & ~held), np.flatnonzero(usable & held)
    rng = np.random.default_rng(SEED)
    embed = rng.normal(0, 0.1, (1 << BITS, SIZE))
    weight, bias = rng.normal(0, 0.1, (SIZE, len(languages))), np.zeros(len(languages))
    squares, w_squares = np.full(1 << BITS, 1e-8), 1e-8
    for _ in range(rounds):
        for i in rng.permutation(fit):
            ids, share = bags[i][0], share_of(i)
            mean = share @ embed[ids]
            z = mean @ weight + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[target[i]] -= 1.0
            back = weight @ p
            w_squares += float((mean**2).sum() * (p**2).sum() + (p**2).sum()) / SIZE
            squares[ids] += share**2 * float((back**2).mean())
            weight -= rate / np.sqrt(w_squares) * np.outer(mean, p) * 0.5
            bias -= rate / np.sqrt(w_squares) * p * 0.1
            embed[ids] -= (rate / np.sqrt(squares[ids]) * share)[:, None] * back[None, :] * 0.2
    table = embed @ weight
    often = np.zeros((1 << BITS, len(languages)))
    for i in fit:
        often[bags[i][0], target[i]] += share_of(i)
    often = np.log((1 - UNSEEN) * often / np.maximum(often.sum(axis=0), 1) + UNSEEN / (1 << BITS))
    typical = np.array([share_of(i) @ often[bags[i][0], target[i]] for i in range(len(bags))])
    # A language without a calibration text is held to the texts it was fitted on.
    usual = np.array([np.median(typical[own if len(own) else fit[target[fit] == k]]) if len(own) or (target[fit] == k).any() else -np.inf for k, own in ((k, check[target[check] == k]) for k in range(len(languages)))])
    model = Model(languages, np.hstack((table, often)), bias, 1.0, 0.0, usual)
    if len(check):
        below = (usual[target[check]] - typical[check]) / room(lengths[check])
        model.width = max(WIDTH * float(np.quantile(below, 0.99)), LEAST_WIDTH)
        z = np.array([share_of(i) @ table[bags[i][0]] + bias for i in check])
        z -= z.max(axis=1, keepdims=True)
        best = None
        for t in np.geomspace(0.05, 20, 60):
            e = z / t
            loss = float((np.log(np.exp(e).sum(axis=1)) - e[np.arange(len(check)), target[check]]).mean())
            if best is None or loss < best[0]:
                best = (loss, float(t))
        model.temperature = best[1]
        e = np.exp(z / model.temperature)
        model.threshold = 0.5 * float(np.quantile((e / e.sum(axis=1, keepdims=True)).max(axis=1), 0.001))
    return model


def fit(docs: DataFrame, key: str = "doc_id", per_language: int = 500, languages: int = 200) -> Model:
    """Trains on labelled rows (key, text, lang): at most ``per_language`` texts of each of ``languages`` languages."""
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(languages).collect()}
    if not counts:
        return train([], [])
    place = F.pmod(F.xxhash64(F.col(key).cast("string"), F.lit(SEED)), F.lit(1 << 40))
    # The rate leaves a little over the bound; the rest is cut off below by the same hash.
    rate = F.create_map(*[x for name, n in counts.items() for x in (F.lit(name), F.lit(int(min(1.0, (per_language * 1.2 + 20) / n) * (1 << 40))))])
    chosen = rows.withColumn("place", place).where(F.col("place") < rate[F.col("lang")]).select("lang", "place", F.col(key).cast("string").alias("id"), "text")

    def bagged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = per_worker("letters", _letters)
        for batch in batches:
            bags = [bag(t, letters) for t in batch.column(3).to_pylist()]
            packed = [pa.array([b[k].astype("<i4").tobytes() for b in bags], pa.binary()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *packed], names=["lang", "place", "id", "ids", "counts"])

    # Bags stay in Arrow buffers; the arrays below are views of them.
    found = chosen.mapInArrow(frugal(bagged, "letters"), "lang string, place long, id string, ids binary, counts binary").toArrow()
    found = found.sort_by([("place", "ascending"), ("id", "ascending")])
    seen: dict[str, int] = {}
    bags, labels = [], []
    for name, ids, counts in zip(found["lang"].to_pylist(), found["ids"], found["counts"]):
        if seen.setdefault(name, 0) < per_language:
            seen[name] += 1
            bags.append(tuple(np.frombuffer(x.as_buffer(), "<i4") for x in (ids, counts)))
            labels.append(name)
    del found
    return train(bags, labels)


def predict(docs: DataFrame, model: Model, key: str = "doc_id") -> DataFrame:
    """Rows (key, lang_pred, score, rejected) for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # buckets x 2 per language, both bounded by parameters

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = per_worker("letters", _letters)
        for batch in batches:
            names, scores, rejected = shared.value.score(batch.column(1).to_pylist(), letters)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(scores), pa.array(rejected, pa.bool_())], names=[key, "lang_pred", "score", "rejected"])

    rows = docs.select(key, "text")
    return rows.mapInArrow(frugal(make, "letters"), f"{key} {rows.schema[key].dataType.simpleString()}, lang_pred string, score double, rejected boolean")
