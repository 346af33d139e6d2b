"""Registered queries of the operators, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.bucket_refinement import remove_repeats
from tidemark.llm.compact_windows import repeated_passages
from tidemark.llm.conversation_repair import audit_table
from tidemark.llm.divergence import (
    BINS,
    COMMON_WORDS,
    MAX_BOTH,
    MAX_CLASS_DISTANCE,
    MAX_REPEATED_PERCENT,
    MIN_CLASS_CHARS,
    MIN_COMMON_WORDS,
    MIN_WORDS,
    judge,
)
from tidemark.llm.language_id import fit_language_model, identify, is_held_out
from tidemark.llm.license_scan import TEMPLATES, scan_licenses
from tidemark.llm.minmax_dedup import near_components
from tidemark.llm.mixing import mix_sources
from tidemark.llm.positional_index import decontaminate
from tidemark.llm.secret_scan import ACCESS, ASSIGN, HEX, NOVEL, find_secrets, told
from tidemark.llm.separator_scan import count_tokens, write_token_files
from tidemark.llm.slot_negatives import mine_hard_negatives
from tidemark.llm.token_records import read_digests, write_records

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[name] = f
        if sql is not None:
            SQL[name] = sql
        return f

    return register


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def _template_rows() -> str:
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    return ", ".join(f"({quoted(n)}, {quoted(t)})" for n, t in sorted(TEMPLATES.items()))


OP1_SQL = rf"""
WITH texts AS (
  SELECT row_number() OVER () AS row, doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '') AS words
  FROM documents),
templates AS (
  SELECT name, list_filter(string_split_regex(lower(text), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '') AS words FROM (VALUES {_template_rows()}) AS t(name, text)),
wanted AS (
  SELECT name, i.shingle, count(*) OVER (PARTITION BY name) AS n
  FROM (SELECT DISTINCT name, array_to_string(words[g.i : g.i + 4], ' ') AS shingle
        FROM templates, LATERAL (SELECT unnest(range(1, len(words) - 3)) AS i) g) AS i),
shingles AS (
  SELECT DISTINCT row, array_to_string(words[g.i : g.i + 4], ' ') AS shingle
  FROM texts, LATERAL (SELECT unnest(range(1, len(words) - 3)) AS i) g),
found AS (
  SELECT row, name, 100 * count(*) / max(n) AS percent FROM shingles JOIN wanted USING (shingle) GROUP BY row, name
  HAVING 100 * count(*) >= 80 * max(n))
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(count(name) AS BIGINT) AS n_licenses,
       coalesce(string_agg(name, ',' ORDER BY name), '') AS licenses
FROM texts LEFT JOIN found USING (row) GROUP BY row, doc_id, words
"""


@query("op1_license_scan", OP1_SQL)
def op1_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = scan_licenses(documents(spark, folder))
    return found.select(
        "doc_id", "n_words", F.size("licenses").cast("long").alias("n_licenses"),
        F.concat_ws(",", F.sort_array(F.col("licenses.name"))).alias("licenses"),
    )


@query("op2_token_records")
def op2_token_records(spark: SparkSession, folder: str) -> DataFrame:
    return read_digests(write_records(documents(spark, folder)))


OP6_SQL = r"""
WITH rows AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || '|' || coalesce(text, '')), 1, 15) AS BIGINT) AS place
  FROM documents),
totals AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM rows GROUP BY source),
weighed AS (
  SELECT *, CAST(1 + (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 AS DOUBLE) AS weight,
         CAST(3 AS DOUBLE) * source_size AS cap FROM totals),
filled AS (
  SELECT *, (CAST(sum(source_size) OVER () AS DOUBLE) - coalesce(sum(cap) OVER (ORDER BY cap / weight, source ASC NULLS LAST
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY cap / weight, source ASC NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS share
  FROM weighed),
level AS (SELECT arg_min(share, cap / weight) AS share FROM filled WHERE cap > share * weight),
targets AS (
  SELECT f.source, f.source_size,
         CASE WHEN f.cap <= f.share * f.weight OR l.share IS NULL THEN f.cap ELSE l.share * f.weight END AS target
  FROM filled f CROSS JOIN level l),
plan AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS copies FROM targets),
summed AS (
  SELECT r.*, p.source_size, p.target, p.copies, p.target - p.copies * p.source_size AS budget,
         sum(r.size) OVER (PARTITION BY r.source ORDER BY r.place RANGE UNBOUNDED PRECEDING) AS after,
         sum(r.size) OVER (PARTITION BY r.source, r.place) AS n
  FROM rows r JOIN plan p ON r.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target,
       size * (copies + CASE WHEN 2 * after - n <= 2 * budget THEN 1 ELSE 0 END) AS taken
FROM summed
"""


@query("op6_mix_sources", OP6_SQL)
def op6_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    mix = mix_sources(documents(spark, folder))
    return mix.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


@query("op7_separator_scan")
def op7_separator_scan(spark: SparkSession, folder: str) -> DataFrame:
    return count_tokens(write_token_files(documents(spark, folder))).select("doc_no", "n_tokens", "ended")


@query("op8_compact_windows")
def op8_compact_windows(spark: SparkSession, folder: str) -> DataFrame:
    return repeated_passages(documents(spark, folder)).drop("text_key")


@query("op9_language_id")
def op9_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    model = fit_language_model(docs.filter(~is_held_out(F.col("doc_id"))))
    return identify(docs.select("doc_id", "text"), model).select(
        "doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score"
    )


def _op3_sql() -> str:
    """The rules of `divergence` in SQL: both histograms, their references and the verdict."""
    letters = "regexp_replace(ink, '[a-z]+', '', 'g')"
    left = lambda pattern: f"len(rest) - len(regexp_replace(rest, '{pattern}', '', 'g'))"
    classes = ["len(ink) - len(rest)", left("[A-Z]+"), left("[0-9]+"), left(r"[.,;:!?''\"()\-]+"), left(r"[#*$%&|<>]+"), left(r"[^\x00-\x7F]+"), "len(text) - len(ink)"]
    listed = ", ".join(f"'{w}'" for w in BINS)
    counts = ", ".join(f"len(list_filter(common, lambda x: x = '{w}'))" for w in BINS)
    share = lambda h: f"CASE WHEN list_sum({h}) > 0 THEN list_transform({h}, lambda x: CAST(x AS DOUBLE) / list_sum({h})) ELSE list_transform({h}, lambda x: 0.0) END"
    part = lambda x, y: f"CASE WHEN {x} > 0 THEN {x} * log2(2 * {x} / ({x} + {y})) ELSE 0 END"
    js = lambda p, q: f"sqrt(greatest(list_sum(list_transform(list_zip({p}, {q}), lambda z: ({part('z[1]', 'z[2]')} + {part('z[2]', 'z[1]')}) / 2)), 0))"
    total = lambda h, n: "[" + ", ".join(f"sum({h}[{i}])" for i in range(1, n + 1)) + "]"
    spaces = r"[\x20\x09-\x0D]+"
    return rf"""
WITH t AS (SELECT row_number() OVER () AS row, doc_id, lang, coalesce(text, '') AS text FROM documents),
a AS (SELECT *, list_filter(string_split_regex(text, '{spaces}'), lambda x: x <> '') AS w, regexp_replace(text, '{spaces}', '', 'g') AS ink,
        list_filter(string_split_regex(lower(text), '[^\p{{L}}]+'), lambda x: x IN ({listed})) AS common,
        len(regexp_extract_all(text, '\p{{L}}+')) AS letter_words,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM t),
b AS (SELECT *, {letters} AS rest FROM a),
c AS (SELECT *, [{", ".join(classes)}] AS c7, [{counts}, letter_words - len(common)] AS commons FROM b),
e AS (SELECT * EXCLUDE (c7), list_append(c7, len(text) - list_sum(c7)) AS classes FROM c),
refs AS (SELECT lang, {share("classes")} AS classes, {share("commons")} AS commons FROM (
  SELECT lang, {total("classes", 8)} AS classes, {total("commons", len(BINS) + 1)} AS commons FROM e WHERE lang IN ({", ".join(f"'{x}'" for x in COMMON_WORDS)}) GROUP BY lang)),
shown AS (SELECT row, lang, {share("classes")} AS p, {share("commons")} AS q FROM e),
far AS (SELECT row, shown.lang AS own, refs.lang AS lang, {js("p", "refs.classes")} AS dc, {js("q", "refs.commons")} AS dw FROM shown, refs),
chosen AS (SELECT row, coalesce(min(dc) FILTER (own = lang), min(dc)) AS dc, coalesce(min(dw) FILTER (own = lang), min(dw)) AS dw FROM far GROUP BY row),
windows AS (SELECT row, g.i, array_to_string(w[g.i : g.i + 7], ' ') AS s FROM a, LATERAL (SELECT unnest(range(1, len(w) - 6)) AS i) g),
again AS (SELECT row, i FROM windows QUALIFY count(*) OVER (PARTITION BY row, s) > 1),
repeated AS (SELECT row, count(DISTINCT p) AS n FROM (SELECT row, unnest(range(i, i + 8)) AS p FROM again) GROUP BY row),
f AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(ink) AS BIGINT) AS word_chars, CAST(classes[5] AS BIGINT) AS n_symbols,
        CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words, dc, dw
      FROM e LEFT JOIN repeated USING (row) LEFT JOIN chosen USING (row))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED_PERCENT} * n_words AS base_failed,
       NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED_PERCENT} * n_words)
       AND NOT coalesce((word_chars >= {MIN_CLASS_CHARS} AND dc > {MAX_CLASS_DISTANCE}) OR (n_words >= {MIN_COMMON_WORDS} AND dc > {MAX_BOTH[0]} AND dw > {MAX_BOTH[1]}), false) AS kept
FROM f"""


OP3_SQL = _op3_sql()


@query("op3_divergence_rules", OP3_SQL)
def op3_divergence_rules(spark: SparkSession, folder: str) -> DataFrame:
    return judge(documents(spark, folder)).drop("text_key", "class_distance", "word_distance")


# Lower case for A-Z only.
_FOLDED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP4_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all({_FOLDED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_FOLDED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
wanted AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[g.i : g.i + least(len(w), 10) - 1], ' ') AS s
  FROM b, LATERAL (SELECT unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i) g WHERE len(w) > 0),
held AS (
  SELECT doc_id, g.i, k.n, array_to_string(w[g.i : g.i + k.n - 1], ' ') AS s
  FROM d, (SELECT DISTINCT n FROM wanted) k, LATERAL (SELECT unnest(range(1, len(w) - k.n + 2)) AS i) g),
found AS (SELECT doc_id, i, n, item_id FROM held JOIN wanted USING (n, s)),
hits AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@query("op4_positional_index", OP4_SQL)
def op4_positional_index(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate(documents(spark, folder), spark.read.parquet(f"{folder}/benchmark.parquet"))
    return found.drop("text_key")


OP5_SQL = rf"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(regexp_extract_all({_FOLDED}, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[g.i : g.i + 2], ' ') AS s
  FROM d, LATERAL (SELECT unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i) g WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reached AS (SELECT doc_id AS a, doc_id AS b FROM sizes UNION SELECT r.a, w.b FROM reached r JOIN ways w ON w.a = r.b),
least AS (SELECT a AS doc_id, min(b) AS component_id FROM reached GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(component_id, doc_id) AS component_id, coalesce(component_id, doc_id) = doc_id AS kept
FROM d LEFT JOIN sizes USING (doc_id) LEFT JOIN least USING (doc_id)
"""


@query("op5_minmax_dedup", OP5_SQL)
def op5_minmax_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = near_components(documents(spark, folder))
    return found.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


@query("op10_bucket_refinement")
def op10_bucket_refinement(spark: SparkSession, folder: str) -> DataFrame:
    return remove_repeats(documents(spark, folder), with_texts=False)


@query("op11_secret_scan")
def op11_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = find_secrets(documents(spark, folder), keep=["doc_id"])
    base = F.filter("secrets", lambda x: x["kind"] != NOVEL)
    count = lambda kind: F.size(F.filter("secrets", lambda x: x["kind"] == kind)).cast("long")
    return found.select(
        "row.doc_id", count(ASSIGN).alias("n_assign"), count(ACCESS).alias("n_access"), count(HEX).alias("n_hex"),
        F.sha2(told(base), 256).alias("base_sha256"), told(F.col("secrets")).alias("spans"), count(NOVEL).alias("n_novel"),
    )


OP12_SQL = """
WITH v AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
r AS (SELECT row_number() OVER () AS row, * FROM v),
scored AS (
  SELECT a.row AS a, a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
         CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM r a, r b WHERE a.vec_id % 100 = 0 AND a.row <> b.row AND len(a.q) = len(b.q)),
positives AS (
  SELECT *, row_number() OVER (PARTITION BY a ORDER BY score DESC, id) AS place FROM scored WHERE same QUALIFY place <= 5),
found AS (
  SELECT p.anchor_id, p.id AS positive_id, row_number() OVER (PARTITION BY p.a, p.place ORDER BY n.score DESC, n.id) AS rank,
         n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
  FROM positives p JOIN scored n ON n.a = p.a AND NOT n.same AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM found WHERE rank <= 10
"""


@query("op12_hard_negatives", OP12_SQL)
def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    vectors = spark.read.parquet(f"{folder}/embeddings.parquet")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_hard_negatives(vectors.select("vec_id", "embedding", label.alias("label")))


def damage(conversations: DataFrame) -> DataFrame:
    """Rows dropped, emptied, stripped of sentence ends, repeated or given to the user, by a hash of their key."""
    spoken = conversations.select("conv_id", "turn", *[F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")])
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    drawn = spoken.withColumn("drawn", F.crc32(key.cast("binary")) % 20).filter("drawn <> 0")
    text = F.when(F.col("drawn") == 1, "").when(F.col("drawn") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("drawn") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.sequence(F.lit(1), F.when(F.col("drawn") == 3, 2).otherwise(1)))
    return drawn.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


def _op13_sql() -> str:
    """Damage, faults and the audit table in SQL; the cheapest audits by a step per row over four states."""
    space = r"\x20\x09-\x0D"

    def edit(state: int, cost: str, letter: str, line: str = "", only: str = "true") -> str:
        lines = f"s{state}.o || CASE WHEN s{state}.o = '' THEN '' ELSE chr(10) END || {line}" if line else f"s{state}.o"
        return f"CASE WHEN s{state}.c IS NOT NULL AND {only} THEN {{'c': s{state}.c + {cost}, 'a': s{state}.a || '{letter}', 'o': {lines}}} END"

    def least(*found: str) -> str:
        return f"list_sort(list_filter([{', '.join(found)}], lambda x: x.c IS NOT NULL))[1]"

    may, keep = "fault < 2", "role || ':' || text"
    kept = lambda s, initial: edit(s, "extra", "K", keep, f"{may} AND left(role, 1) = '{initial}'")
    reroled = lambda s, role: edit(s, "extra + 1", "R", f"'{role}:' || text", may)
    dropped = lambda s: edit(s, "2", "D")
    put = lambda s, role: edit(s, "5", "I", f"'{role}:'")
    empty = "{'c': CAST(0 AS BIGINT), 'a': '', 'o': ''}"
    none = "{'c': CAST(NULL AS BIGINT), 'a': '', 'o': ''}"
    return rf"""
WITH RECURSIVE tab AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) AS c
    FROM (SELECT unnest(range(256)) AS i))),
drawn AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(list_reduce(list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda x: CAST(ascii(x) AS BIGINT)),
             lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8), 4294967295), 4294967295) % 20 AS d
  FROM conversations, tab),
damaged AS (
  SELECT conv_id, turn, CASE WHEN d = 4 THEN 'user' ELSE role END AS role,
         CASE d WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE WHEN d = 3 THEN 2 ELSE 1 END)) AS copy
  FROM drawn WHERE d <> 0),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(len(role) || ':' || role || text)) AS i FROM damaged),
faulty AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^{space}]') THEN 2
                 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 3
                 WHEN NOT regexp_matches(text, '[.!?][{space}]*\z') THEN 1 ELSE 0 END AS fault,
         lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before
  FROM numbered),
steps AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, {empty} AS s0, {none} AS s1, {{'c': CAST(5 AS BIGINT), 'a': 'I', 'o': 'user:'}} AS s2,
         {{'c': CAST(10 AS BIGINT), 'a': 'II', 'o': 'user:' || chr(10) || 'assistant:'}} AS s3
  FROM (SELECT DISTINCT conv_id FROM faulty)
  UNION ALL
  SELECT conv_id, i, s0, s1, s2, {least("s3", put(2, "assistant"))} AS s3 FROM (
    SELECT conv_id, i, s0, s1, {least("s2", put(0, "user"), put(1, "user"), put(3, "user"))} AS s2, s3 FROM (
      SELECT f.conv_id, f.i, {least(dropped(0))} AS s0, {least(dropped(1), kept(0, "s"))} AS s1,
             {least(dropped(2), kept(0, "u"), kept(1, "u"), kept(3, "u"), reroled(0, "user"), reroled(1, "user"), reroled(3, "user"))} AS s2,
             {least(dropped(3), kept(2, "a"), reroled(2, "assistant"))} AS s3
      FROM steps s JOIN (SELECT *, CASE WHEN fault = 1 THEN 5 ELSE 0 END AS extra FROM faulty) f ON s.conv_id IS NOT DISTINCT FROM f.conv_id AND f.i = s.i + 1))),
ended AS (
  SELECT conv_id, {least("s0", "s3")} AS s FROM steps QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 2) AS blank, count(*) FILTER (fault = 3) AS duplicate,
         count(*) FILTER (fault = 1) AS truncated, count(*) FILTER (i > 1 AND before || left(role, 1) NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faulty GROUP BY conv_id)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(s.c, 0) AS cost, coalesce(s.a, '') AS audit, sha256(coalesce(s.o, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN ended e ON o.conv_id IS NOT DISTINCT FROM e.conv_id LEFT JOIN counts c ON o.conv_id IS NOT DISTINCT FROM c.conv_id"""


OP13_SQL = _op13_sql()


@query("op13_conversation_repair", OP13_SQL)
def op13_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    conversations = spark.read.parquet(f"{folder}/conversations.parquet")
    return audit_table(conversations, damage(conversations))
