"""Benchmark decontamination by template windows, in DataFrame functions only.

Texts are made canonical: names (capitalised words inside a sentence), numbers and units after a number become typed
placeholders, letters are lower-cased, the rest is blanks. Windows of ``window`` canonical words are hash-joined between
benchmark items and documents. Windows of one document and item with the same offset form a run. A run counts its
windows without placeholders, and those with placeholders too if its slots are filled consistently: equal values of the
item stand for equal values of the document and different ones for different ones. A document is contaminated if a run
counts ``least`` windows (13 words in a row by default), or all windows of an item that has fewer.

Benchmark windows are broadcast in blocks of at most ``BLOCK`` rows, however many there are; documents are read once
per block and their windows are never shuffled (once more where matching windows hold placeholders). Null and empty texts, and items or documents of fewer than ``window``
words, match nothing. An item given twice reports both ids. Every document gets a row (repeated ones each).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import stored

NAME, NUMBER, UNIT = "\ue001", "\ue002", "\ue003"  # private-use characters, one for each kind
BLOCK = 500_000
# Unit words that count as such after a number.
UNITS = (
    "km|m|cm|mm|kg|g|mg|lb|lbs|oz|ml|l|mph|kmh|miles?|meters?|metres?|inch|inches|foot|feet|yards?|acres?|hours?|minutes?|seconds?|"
    "days?|weeks?|months?|years?|dollars?|euros?|cents?|pounds?|percent|degrees?|liters?|litres?|gallons?|cups?|tons?|grams?|kilograms?"
)
NAMES_RE = r"([\p{Ll},;] )(\p{Lu}\p{L}*(?: \p{Lu}\p{L}*)*)"
NUMBERS_RE = r"([0-9]+(?:[.,:/][0-9]+)*)"
UNITS_RE = f"({NUMBER} ?)((?:{UNITS}))([^\\p{{L}}]|$)"
OTHER_RE = f"[^\\p{{L}}{NAME}-{UNIT}]+"
# The SQL has NAMES_RE and NUMBERS_RE as they stand. Java follows a repeated group by recursion, a thousand names in a row
# over its stack, but a possessive one by a loop. Both find the same: nothing stands after the group that it could give way to.
NAMES_LOOP, NUMBERS_LOOP = (p.removesuffix(")*)") + ")*+)" for p in (NAMES_RE, NUMBERS_RE))


def _marked(text: Column) -> Column:
    """Names and numbers replaced, lower case, units still in place."""
    named = F.regexp_replace(text, NAMES_LOOP, f"$1 {NAME} ")
    return F.regexp_replace(F.lower(named), NUMBERS_LOOP, f" {NUMBER} ")


def _canonical(marked: Column) -> Column:
    units = F.regexp_replace(marked, UNITS_RE, f"$1 {UNIT} $3")
    return F.split(F.trim(F.regexp_replace(units, OTHER_RE, " ")), " ")


def _words(rows: DataFrame, key: str) -> DataFrame:
    """Rows (key, t, marked, words)."""
    t = F.coalesce(F.col("text"), F.lit(""))
    return rows.select(key, t.alias("t")).withColumn("marked", _marked(F.col("t"))).withColumn("words", _canonical(F.col("marked")))


def windows(rows: DataFrame, key: str, size: int) -> DataFrame:
    """Rows (key, pos, h): the windows of every text. Only the key is carried along when they are spread out."""
    hashes = F.when(F.size("words") >= size, F.transform(F.sequence(F.lit(1), F.size("words") - (size - 1)), lambda i: F.xxhash64(F.slice("words", i, size))))
    # The outer form: for the plain one a filter on the array's size is put before the scan, which would compute it twice.
    return _words(rows, key).select(key, hashes.alias("hashes")).select(key, F.posexplode_outer("hashes").alias("pos", "h")).where("h is not null")


def _slots(size: int) -> Column:
    """Placeholder values inside the window at ``pos``: an array of struct(at, value), null if there is none."""
    names = F.regexp_extract_all("t", F.lit(NAMES_LOOP), 2)
    numbers = F.regexp_extract_all(F.lower("t"), F.lit(NUMBERS_LOOP), 1)
    units = F.regexp_extract_all("marked", F.lit(UNITS_RE), 2)

    def value(i):
        kind = F.element_at("words", i)
        rank = F.size(F.filter(F.slice(F.col("words"), F.lit(1), i), lambda w: w == kind))
        return F.struct(
            (i - F.col("pos")).alias("at"),
            F.when(kind == NAME, F.concat(F.lit("n"), F.get(names, rank - 1)))
            .when(kind == NUMBER, F.concat(F.lit("d"), F.get(numbers, rank - 1)))
            .when(kind == UNIT, F.concat(F.lit("u"), F.get(units, rank - 1))).alias("value"),
        )

    places = F.filter(F.sequence(F.col("pos") + 1, F.col("pos") + size), lambda i: F.element_at("words", i).isin(NAME, NUMBER, UNIT))
    return F.when(F.exists(F.slice("words", F.col("pos") + 1, size), lambda w: w.isin(NAME, NUMBER, UNIT)), F.transform(places, value))


def matches(docs: DataFrame, items: DataFrame, size: int) -> DataFrame:
    """Windows that documents share with items: (doc_id, item_id, pos, item_pos, item_slots), a stored table."""
    bench = stored(windows(items, "item_id", size).join(_words(items, "item_id"), "item_id").select("item_id", F.col("pos").alias("item_pos"), "h", _slots(size).alias("item_slots")))
    blocks = max(1, -(-bench.count() // BLOCK))
    found = None
    for b in range(blocks):
        part = bench.where(F.pmod("h", F.lit(blocks)) == b) if blocks > 1 else bench
        hit = windows(docs, "doc_id", size).join(F.broadcast(part), "h").select("doc_id", "item_id", "pos", "item_pos", "item_slots")
        found = hit if found is None else found.union(hit)
    return stored(found)


def broken_runs(docs: DataFrame, hits: DataFrame, run: list[str], size: int) -> DataFrame:
    """Runs whose slots are filled inconsistently."""
    slotted = hits.where("item_slots is not null")
    if not slotted.limit(1).count():
        return slotted.select(*run)
    filled = (
        slotted.join(_words(docs, "doc_id"), "doc_id").withColumn("slots", _slots(size))
        .select(*run, F.explode(F.arrays_zip("slots", "item_slots")).alias("z"))
        .select(*run, F.col("z.slots.value").alias("doc_value"), F.col("z.item_slots.value").alias("item_value")).distinct()
    )
    by_item = filled.groupBy(*run, "item_value").agg(F.count("*").alias("n"))
    by_doc = filled.groupBy(*run, "doc_value").agg(F.count("*").alias("n"))
    return by_item.select(*run, "n").union(by_doc.select(*run, "n")).where("n > 1").select(*run).distinct()


def contaminated(docs: DataFrame, items: DataFrame, window: int = 8, least: int = 6) -> DataFrame:
    """One row per document: doc_id, contaminated, n_items, items (ids, ascending), n_windows (most in a run)."""
    docs = docs.select("doc_id", "text")
    items = items.select("item_id", "text")
    # Items that share an id count as one; so do documents.
    run = ["doc_id", "item_id", "offset"]
    hits = matches(docs, items, window).withColumn("offset", F.col("pos") - F.col("item_pos"))
    broken = broken_runs(docs, hits, run, window).withColumn("broken", F.lit(True))
    counted = (
        hits.groupBy(*run).agg(F.countDistinct("item_pos").alias("all_windows"), F.countDistinct(F.when(F.col("item_slots").isNull(), F.col("item_pos"))).alias("plain"))
        .join(broken, run, "left").withColumn("n", F.when(F.col("broken"), F.col("plain")).otherwise(F.col("all_windows")))
    )
    sizes = windows(items, "item_id", window).groupBy("item_id").agg(F.countDistinct("pos").alias("has"))
    bad = (
        counted.join(sizes, "item_id").where(F.col("n") >= F.least(F.lit(least), F.col("has"))).where("n > 0")
        .groupBy("doc_id").agg(F.array_sort(F.collect_set("item_id")).alias("items"), F.max("n").alias("n_windows"))
    )
    return docs.select("doc_id").join(bad, "doc_id", "left").select(
        "doc_id", F.col("items").isNotNull().alias("contaminated"), F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items", F.array().cast("array<long>")).alias("items"), F.coalesce("n_windows", F.lit(0)).cast("long").alias("n_windows"),
    )
