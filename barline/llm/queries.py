"""The operators as queries over the given tables, with SQL where SQL can state them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from barline.llm import chat, collocations, decontaminate, fingerprint, language, linededup, mixing, neardup, packing, pii, repair, toxicity, warc
from barline.llm.tables import remainder, table
from barline.queries.registry import Query, QueryFunction
from barline.session import tune

REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register a query of (spark, sf_dir) as it is: its result's types are its contract."""

    def register(function: QueryFunction) -> QueryFunction:
        REGISTRY[name] = Query(lambda spark, sf_dir: function(tune(spark), sf_dir), sql)
        return function

    return register


@query("op1_neardup")
def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neardup.classes(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "class_size", "keep")


@query("op2_fingerprint")
def fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprints(table(spark, sf_dir, "documents"))


@query("op3_decontaminate")
def leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "share")


@query("op4_pii")
def personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.summary(pii.find(table(spark, sf_dir, "documents")))


@query("op5_linededup")
def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.drop_repeated_lines(table(spark, sf_dir, "documents"), short=True).select("doc_id", "text", "n_chars")


# Base32 of a SHA-1 digest, five hexadecimal digits to four characters.
BASE32 = (
    "list_aggregate(list_transform(range(32), lambda j: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST("
    "(CAST('0x' || substr(sha, CAST(1 + 5 * (j // 4) AS BIGINT), 5) AS BIGINT) >> (15 - 5 * (j % 4))) & 31 AS BIGINT), 1)),"
    " 'string_agg', '')"
)


@query(
    "op6_warc",
    f"""WITH payloads AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
measured AS (SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes, sha1(html) AS sha,
    max(page_id) OVER (PARTITION BY html) AS keeper FROM payloads)
SELECT page_id, payload_bytes, {BASE32} AS payload_digest,
  CASE WHEN page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> keeper THEN keeper END AS refers_to FROM measured""",
)
def archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(table(spark, sf_dir, "pages")).drop("url")


@query("op7_language")
def languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.languages(table(spark, sf_dir, "documents"), remainder(3) == 1, remainder(3) != 1)


def escaped_sql(column: str) -> str:
    for plain, code in chat.ESCAPES:
        column = f"replace({column}, '{plain}', '{code}')"
    return column


@query(
    "op8_chat",
    rf"""WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
whole AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS said,
    coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '') AS loss,
    string_agg('### ' || {escaped_sql("role")} || ': ' || {escaped_sql("text")} || ' </turn>' || chr(10), '') AS formatted,
    count(*) FILTER (WHERE role = 'assistant') AS n_examples
  FROM turns GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
  length(formatted) AS formatted_chars, n_examples FROM whole""",
)
def chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = r"\### Assistant: </turn> ok"
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-7).cast("bigint"), F.col("id"), F.when(F.col("id") == 0, "user").otherwise("assistant"), F.lit(said)
    )
    return chat.summary(chat.format_chats(given.union(extra)))


@query("op9_packing")
def packs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op10_toxicity")
def toxic(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (table(spark, sf_dir, name) for name in ("documents", "labels"))
    return toxicity.scored(docs, labels, remainder(5) == 0, remainder(5) != 0)


MIX_SQL = r"""WITH given AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    CAST('0x' || substr(md5('mix' || coalesce(CAST(doc_id AS VARCHAR), '') || chr(10) || coalesce(text, '')), 1, 13)
      AS BIGINT) / 4503599627370496.0::DOUBLE AS draw FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS HUGEINT) AS source_size,
    CAST(1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS HUGEINT) AS weight FROM given GROUP BY source),
filled AS (
  SELECT *, sum(source_size) OVER () AS total, sum(weight) OVER () AS weights,
    coalesce(sum(source_size) OVER before, 0) AS size_before, coalesce(sum(weight) OVER before, 0) AS weight_before
  FROM sources WINDOW before AS (ORDER BY source_size * 6 / weight, source NULLS LAST
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
capped AS (
  SELECT *, weight * (total - 3 * size_before) > 3 * source_size * (weights - weight_before) AS is_full FROM filled),
level AS (
  SELECT max(total) - 3 * coalesce(sum(source_size) FILTER (WHERE is_full), 0) AS num,
    max(weights) - coalesce(sum(weight) FILTER (WHERE is_full), 0) AS den FROM capped),
targets AS (
  SELECT source, CAST(source_size AS BIGINT) AS source_size,
    CASE WHEN is_full THEN CAST(3 * source_size AS DOUBLE) ELSE CAST(weight * num AS DOUBLE) / CAST(den AS DOUBLE) END
      AS target FROM capped, level),
rated AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate FROM targets)
SELECT g.doc_id, g.size, r.source_size, r.target, CAST(g.size * (floor(r.rate) +
    CASE WHEN g.draw < r.rate - floor(r.rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM given g JOIN rated r ON g.source IS NOT DISTINCT FROM r.source"""


@query("op11_mixing", MIX_SQL)
def mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.allotted(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return found.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


REPAIR_SQL = r"""WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
-- CRC-32, a bit at a time.
hashed AS (
  SELECT *, xor(list_reduce(list_transform(string_split(k, ''), lambda c: CAST(ord(c) AS BIGINT)),
    lambda crc, b: list_reduce(CAST(range(8) AS BIGINT[]), lambda x, i: CASE WHEN x & 1 = 1
      THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, xor(crc, b)), 4294967295), 4294967295) % 20 AS kind FROM keyed),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) FROM hashed WHERE kind <> 0),
placed AS (
  SELECT coalesce(CAST(conv_id AS VARCHAR), '') AS conv, turn, role, text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
    rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS said, substr(role, 1, 1) AS initial
  FROM damaged),
told AS (
  SELECT *, said = '' AS blank, row_number() OVER (PARTITION BY conv, role, text ORDER BY i) > 1 AS again,
    substr(said, length(said), 1) NOT IN ('.', '!', '?') AS open,
    coalesce(lag(initial) OVER (PARTITION BY conv ORDER BY i) || initial NOT IN ('su', 'ua', 'au'), false) AS illegal
  FROM placed),
found AS (
  SELECT conv, i, role, text, turn, initial, blank, NOT blank AND again AS duplicate,
    NOT blank AND NOT again AND open AS truncated, illegal FROM told),
sums AS (
  SELECT conv, CAST(coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS BIGINT) AS gaps,
    count(*) FILTER (WHERE blank) AS blank, count(*) FILTER (WHERE duplicate) AS duplicate,
    count(*) FILTER (WHERE truncated) AS truncated, count(*) FILTER (WHERE illegal) AS illegal, count(*) AS n
  FROM found GROUP BY conv),
-- States: 0 nothing yet, 1 system, 2 user, 3 assistant last.
gap(q, letters, after) AS (VALUES (0, '', 0), (1, '', 1), (2, '', 2), (3, '', 3), (0, 'I', 2), (1, 'I', 2), (3, 'I', 2),
  (2, 'I', 3), (0, 'II', 3), (1, 'II', 3), (3, 'II', 3), (2, 'II', 2)),
keep(initial, q, after) AS (VALUES ('s', 0, 1), ('u', 0, 2), ('u', 1, 2), ('u', 3, 2), ('a', 2, 3)),
step AS (
  SELECT r.conv, r.i, g.q, g.letters || 'D' AS letters, 2 * length(g.letters) + 3 AS cost, g.after
  FROM found r, gap g
  UNION ALL
  SELECT r.conv, r.i, g.q, g.letters || 'K', 2 * length(g.letters) + CAST(truncated AS INT), k.after
  FROM found r, gap g, keep k WHERE NOT blank AND NOT duplicate AND k.initial = r.initial AND k.q = g.after
  UNION ALL
  SELECT r.conv, r.i, g.q, g.letters || 'R', 2 * length(g.letters) + 2 + CAST(truncated AS INT),
    CASE g.after WHEN 2 THEN 3 ELSE 2 END FROM found r, gap g WHERE NOT blank AND NOT duplicate),
best(conv, i, q, path) AS (
  SELECT conv, CAST(0 AS BIGINT), 0, {'cost': CAST(0 AS BIGINT), 'audit': ''} FROM sums
  UNION ALL
  SELECT b.conv, b.i + 1, s.after, min({'cost': CAST(b.path.cost + s.cost AS BIGINT), 'audit': b.path.audit || s.letters})
  FROM best b JOIN step s ON s.conv = b.conv AND s.i = b.i + 1 AND s.q = b.q GROUP BY b.conv, b.i, s.after),
cheapest AS (
  SELECT b.conv, min({'cost': CAST(b.path.cost + 2 * length(g.letters) AS BIGINT), 'audit': b.path.audit || g.letters}) AS path
  FROM best b JOIN sums s ON s.conv = b.conv AND s.n = b.i JOIN gap g ON g.q = b.q AND g.after IN (0, 3) GROUP BY b.conv),
edits AS (
  SELECT conv, unnest(range(1, length(path.audit) + 1)) AS k, substr(path.audit, k, 1) AS letter FROM cheapest),
dealt AS (
  SELECT *, count(*) FILTER (WHERE letter <> 'I') OVER so_far AS i, count(*) FILTER (WHERE letter <> 'D') OVER so_far AS o
  FROM edits WINDOW so_far AS (PARTITION BY conv ORDER BY k)),
joined AS (
  SELECT d.*, r.role, r.text, max(CASE WHEN o = 1 AND letter = 'K' AND r.initial = 's' THEN 1 ELSE 0 END)
    OVER (PARTITION BY d.conv) AS led
  FROM dealt d LEFT JOIN found r ON r.conv = d.conv AND r.i = d.i AND d.letter <> 'I' WHERE letter <> 'D'),
repaired AS (
  SELECT conv, string_agg(CASE WHEN letter = 'K' THEN role WHEN (o + led) % 2 = 1 THEN 'user' ELSE 'assistant' END
    || ':' || coalesce(text, ''), chr(10) ORDER BY k) AS whole FROM joined GROUP BY conv),
names AS (SELECT DISTINCT conv_id, coalesce(CAST(conv_id AS VARCHAR), '') AS conv FROM conversations)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(path.cost, 0) AS cost,
  coalesce(path.audit, '') AS audit, sha256(coalesce(whole, '')) AS repaired_sha256
FROM names LEFT JOIN sums USING (conv) LEFT JOIN cheapest USING (conv) LEFT JOIN repaired USING (conv)"""


@query("op12_repair", REPAIR_SQL)
def repairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations")
    return repair.summary(given, repair.damaged(given))


PHRASE_SQL = r"""WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
worded AS (
  SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') AS w FROM pieces),
placed AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM worded),
grams AS (
  SELECT lang, w[i] AS w1, NULL AS w2, NULL AS w3 FROM placed
  UNION ALL SELECT lang, w[i], w[i + 1], NULL FROM placed WHERE i < len(w)
  UNION ALL SELECT lang, w[i], w[i + 1], w[i + 2] FROM placed WHERE i + 1 < len(w)),
f AS (SELECT lang, w1, w2, w3, count(*) AS a FROM grams GROUP BY ALL),
totals AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE w2 IS NULL GROUP BY lang),
one AS (SELECT * FROM f WHERE w2 IS NULL), two AS (SELECT * FROM f WHERE w2 IS NOT NULL AND w3 IS NULL),
three AS (SELECT * FROM f WHERE w3 IS NOT NULL AND a >= 10),
cuts AS (
  SELECT t.lang, t.w1 || ' ' || t.w2 AS phrase, t.a, 1 AS k, x.a AS l, y.a AS r FROM two t
  JOIN one x ON x.lang = t.lang AND x.w1 = t.w1 JOIN one y ON y.lang = t.lang AND y.w1 = t.w2
  WHERE t.a >= 10 AND NOT EXISTS (FROM three z WHERE z.lang = t.lang AND 100 * z.a >= 50 * t.a
    AND (z.w1 = t.w1 AND z.w2 = t.w2 OR z.w2 = t.w1 AND z.w3 = t.w2))
  UNION ALL
  SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, t.a, 1, x.a, y.a FROM three t
  JOIN one x ON x.lang = t.lang AND x.w1 = t.w1 JOIN two y ON y.lang = t.lang AND y.w1 = t.w2 AND y.w2 = t.w3
  UNION ALL
  SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, t.a, 2, x.a, y.a FROM three t
  JOIN two x ON x.lang = t.lang AND x.w1 = t.w1 AND x.w2 = t.w2 JOIN one y ON y.lang = t.lang AND y.w1 = t.w3),
marked AS (
  SELECT *, CAST((1000000::HUGEINT * a * a) // (l::HUGEINT * r) AS BIGINT) AS score FROM cuts),
kept AS (
  FROM marked QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000"""


@query("op13_collocations", PHRASE_SQL)
def phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


@query("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)
