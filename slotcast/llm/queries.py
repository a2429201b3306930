"""The registered query of each operator, with production parameters over its whole table."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import language, minhash, neighbours, packing, pages, phrases, pieces, ranking, secrets, substrings, templates, toxicity, urls
from .common import read
from .register import ORACLES, QUERIES, register  # noqa: F401


def tokenizer(name: str) -> str:
    """Place of a public vocabulary file; SLOTCAST_TOKENIZERS names another folder."""
    folder = os.environ.get("SLOTCAST_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return str(public_tokenizers.path(name))


def training_rows(docs: DataFrame, parts: int, held: int) -> DataFrame:
    """Rows that may train: crc32 of the id as text, modulo ``parts``, is not ``held``."""
    return docs.where(F.crc32(F.col("doc_id").cast("string")) % parts != held)


@register("op1_pieces")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    encoded = pieces.encode(read(spark, folder, "documents"), tokenizer("piece_bpe_32k.model"))
    return encoded.select(
        "doc_id", F.expr("length(ids) div 4").cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@register("op2_substrings")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    found = substrings.deduplicated(read(spark, folder, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


@register("op3_pages")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return pages.extract(read(spark, folder, "pages"))


@register("op4_secrets")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    found = secrets.secrets(read(spark, folder, "documents"), tokenizer("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    of = lambda *kinds: F.filter("spans", lambda s: s["kind"].isin(*kinds))
    return found.select(
        "doc_id", *(F.size(of(k)).cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")),
        F.sha2(secrets.listed(of("assign", "access", "hex")).cast("binary"), 256).alias("base_sha256"), secrets.listed(F.col("spans")).alias("spans"),
    )


@register("op5_minhash")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(read(spark, folder, "documents"), n=4, percent=80)


@register("op6_language")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").select("doc_id", "text", "lang")
    model = language.fit(training_rows(docs, 4, 2))
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    return language.predict(docs, model).select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "lang_pred", "score")


@register("op7_toxicity")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").select("doc_id", "text")
    machine = toxicity.fit(docs, training_rows(read(spark, folder, "labels"), 3, 1))
    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    return toxicity.scores(docs, machine).select(
        "doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
URL_SQL = """
WITH p AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
q AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p),
r(verdict, h, p) AS (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
m AS (SELECT page_id, max(length(h || p)) AS n FROM q JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY page_id)
SELECT q.page_id, host, path, h || p AS rule, coalesce(verdict, 'allow') AS verdict
FROM q LEFT JOIN (SELECT m.page_id, r.* FROM m JOIN q USING (page_id) JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) AND length(h || p) = n) w
  ON q.page_id = w.page_id
"""


@register("op8_urls", URL_SQL)
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return urls.judged(read(spark, folder, "pages"), RULES)


def template_sql(window: int = 8, least: int = 6) -> str:
    """The canonical form, its windows, runs and slot check, as the operator describes them."""
    t = templates
    slash = lambda pattern: pattern.replace("'", "''")
    names, numbers, units, other = map(slash, (t.NAMES_RE, t.NUMBERS_RE, t.UNITS_RE, t.OTHER_RE))
    return f"""
WITH t AS (SELECT 'd' AS side, doc_id AS id, coalesce(text, '') AS t FROM documents UNION ALL SELECT 'b', item_id, coalesce(text, '') FROM benchmark),
m AS (SELECT *, regexp_replace(lower(regexp_replace(t, '{names}', '\\1 {t.NAME} ', 'g')), '{numbers}', ' {t.NUMBER} ', 'g') AS marked FROM t),
w AS (SELECT *, string_split(trim(regexp_replace(regexp_replace(marked, '{units}', '\\1 {t.UNIT} \\3', 'g'), '{other}', ' ', 'g')), ' ') AS words FROM m),
x AS (SELECT side, id, unnest(range(1, len(words) - {window - 2})) AS pos FROM w WHERE len(words) >= {window}),
k AS (SELECT x.*, array_to_string(words[pos:pos + {window - 1}], ' ') AS key FROM x JOIN w USING (side, id)),
hit AS (SELECT DISTINCT d.id AS doc_id, b.id AS item_id, d.pos, b.pos AS item_pos, d.pos - b.pos AS off, regexp_matches(key, '[{t.NAME}-{t.UNIT}]') AS slotted
  FROM (SELECT * FROM k WHERE side = 'd') d JOIN (SELECT * FROM k WHERE side = 'b') b USING (key)),
s AS (SELECT *, row_number() OVER (PARTITION BY side, id, kind ORDER BY place) AS nth
  FROM (SELECT side, id, unnest(range(1, len(words) + 1)) AS place, unnest(words) AS kind FROM w) WHERE kind IN ('{t.NAME}', '{t.NUMBER}', '{t.UNIT}')),
v AS (SELECT side, id, place, CASE kind WHEN '{t.NAME}' THEN 'n' || regexp_extract_all(t, '{names}', 2)[nth]
  WHEN '{t.NUMBER}' THEN 'd' || regexp_extract_all(lower(t), '{numbers}', 1)[nth] ELSE 'u' || regexp_extract_all(marked, '{units}', 2)[nth] END AS value
  FROM s JOIN w USING (side, id)),
f AS (SELECT DISTINCT h.doc_id, h.item_id, h.off, vd.value AS dv, vb.value AS bv FROM hit h
  JOIN v vd ON vd.side = 'd' AND vd.id = h.doc_id AND vd.place BETWEEN h.pos AND h.pos + {window - 1}
  JOIN v vb ON vb.side = 'b' AND vb.id = h.item_id AND vb.place = vd.place - h.off WHERE slotted),
broken AS (SELECT doc_id, item_id, off FROM f GROUP BY doc_id, item_id, off, bv HAVING count(*) > 1
  UNION SELECT doc_id, item_id, off FROM f GROUP BY doc_id, item_id, off, dv HAVING count(*) > 1),
c AS (SELECT h.doc_id, h.item_id, h.off, count(DISTINCT CASE WHEN b.off IS NULL OR NOT slotted THEN item_pos END) AS n FROM hit h
  LEFT JOIN broken b ON h.doc_id = b.doc_id AND h.item_id = b.item_id AND h.off = b.off GROUP BY h.doc_id, h.item_id, h.off),
has AS (SELECT id AS item_id, count(*) AS has FROM x WHERE side = 'b' GROUP BY 1),
bad AS (SELECT doc_id, array_to_string(list_sort(list(DISTINCT item_id)), ',') AS items, count(DISTINCT item_id) AS n_items, max(n) AS n_windows
  FROM c JOIN has USING (item_id) WHERE n >= least({least}, has) AND n > 0 GROUP BY doc_id)
SELECT doc_id, items IS NOT NULL AS contaminated, coalesce(n_items, 0) AS n_items, coalesce(items, '') AS items, coalesce(n_windows, 0) AS n_windows
FROM documents LEFT JOIN bad USING (doc_id)
"""


@register("op9_templates", template_sql())
def op9(spark: SparkSession, folder: str) -> DataFrame:
    found = templates.contaminated(read(spark, folder, "documents"), read(spark, folder, "benchmark"))
    return found.withColumn("items", F.array_join("items", ","))


@register("op10_neighbours")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    table = read(spark, folder, "embeddings").select("vec_id", "embedding")
    return neighbours.nearest(table, table.where("vec_id % 50 = 0").select(F.col("vec_id").alias("id")), k=5)


LETTERS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
RANK_SQL = rf"""
WITH split AS (SELECT 'd' AS side, doc_id AS id, regexp_extract_all(translate(text, {LETTERS}), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents
  UNION ALL SELECT 'b', item_id, regexp_extract_all(translate(text, {LETTERS}), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') FROM benchmark),
tf AS (SELECT side, id, term, count(*) AS tf FROM (SELECT side, id, unnest(terms) AS term FROM split) GROUP BY ALL),
n AS (SELECT id, sum(tf)::BIGINT AS n FROM tf WHERE side = 'd' GROUP BY id),
c AS (SELECT count(*) AS docs, sum(n)::BIGINT AS total FROM n),
m AS (SELECT id, 100 - 90 + ((90 * n * docs) // total) AS m FROM n, c),
w AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE)) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM tf WHERE side = 'd' GROUP BY term), c),
s AS (SELECT b.id AS item_id, d.id AS doc_id, sum(w * ((1000000000 * d.tf) // (1000 * d.tf + 8 * m)))::BIGINT AS score
  FROM tf d JOIN tf b ON d.side = 'd' AND b.side = 'b' AND d.term = b.term JOIN w ON w.term = d.term JOIN m ON m.id = d.id GROUP BY b.id, d.id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10
"""


@register("op11_ranking", RANK_SQL)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return ranking.ranked(read(spark, folder, "documents"), read(spark, folder, "benchmark"), k=10)


@register("op12_packing")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    found = packing.packed(read(spark, folder, "documents"), tokenizer("byte_bpe_50k.json"), pattern=public_tokenizers.PATTERN)
    return found.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


PHRASE_SQL = rf"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(text, {LETTERS}), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents WHERE text IS NOT NULL),
w AS (SELECT lang, [x for x in regexp_split_to_array(piece, '[\x20\x09]+') if x <> ''] AS words FROM p),
x AS (SELECT lang, words, unnest(range(1, 5)) AS k FROM w),
y AS (SELECT lang, words, k, unnest(range(1, len(words) - k + 2)) AS i FROM x WHERE len(words) >= k),
f AS (SELECT lang, k, array_to_string(words[i:i + k - 1], ' ') AS phrase, count(*) AS f FROM y GROUP BY ALL),
t AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS words FROM f WHERE k > 1 AND f >= 30),
cut AS (SELECT *, unnest(range(1, k)) AS pos FROM c),
s AS (SELECT cut.*, l.f AS l, r.f AS r, CAST((2000000::HUGEINT * a) // (l.f + r.f) AS BIGINT) AS score FROM cut
  JOIN f l ON l.lang = cut.lang AND l.phrase = array_to_string(words[1:pos], ' ') JOIN f r ON r.lang = cut.lang AND r.phrase = array_to_string(words[pos + 1:cut.k], ' ')),
low AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, pos) = 1),
sub AS (SELECT lang, a, words, m, unnest(range(1, k - m + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS m FROM c WHERE k > 2)),
held AS (SELECT lang, array_to_string(words[i:i + m - 1], ' ') AS phrase, max(a) AS longer FROM sub GROUP BY ALL),
kept AS (SELECT low.* FROM low LEFT JOIN held USING (lang, phrase) WHERE longer IS NULL OR 100 * longer::HUGEINT < 80 * low.a::HUGEINT),
r AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM kept JOIN t USING (lang))
SELECT * FROM r WHERE rank <= 2000
"""


@register("op13_phrases", PHRASE_SQL)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(read(spark, folder, "documents"), top=2000)
