"""Each operator over its whole table, next to the SQL it must agree with where SQL can say it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from portdelta.llm import registry
from portdelta.llm.decontaminate import contained_items
from portdelta.llm.line_dedup import line_summary
from portdelta.llm.mixing import mix_sources
from portdelta.llm.near_dedup import near_duplicates
from portdelta.llm.neighbours import nearest
from portdelta.llm.prefix_trie import prefix_trie
from portdelta.llm.quality import describe, fit_quality, score_quality
from portdelta.llm.registry import query, table
from portdelta.llm.secrets import KINDS, scan_secrets
from portdelta.llm.simhash import simhash_groups
from portdelta.llm.substring_dedup import repeated_passages
from portdelta.llm.token_files import read_digests, token_folder, write_tokens
from portdelta.llm.toxicity import fit_toxicity, score_toxicity
from portdelta.llm.vector_codes import ROUNDS, code_report

_WORD_SETS = r"""
words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
                                    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
  FROM words
)"""


@query(
    "op7_minhash_near_dedup",
    f"""
WITH RECURSIVE {_WORD_SETS}, members AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM members a JOIN members b ON a.x = b.x AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), links AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
reach AS (
  SELECT doc_id AS node, doc_id AS other FROM documents
  UNION SELECT r.node, l.b FROM reach r JOIN links l ON l.a = r.other
), component AS (SELECT node, min(other) AS component_id FROM reach GROUP BY node)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, c.component_id, s.doc_id = c.component_id AS kept
FROM sets s JOIN component c ON c.node = s.doc_id
""",
)
def _op7(spark: SparkSession, sf: str) -> DataFrame:
    return near_duplicates(table(spark, sf, "documents"), percent=85)


def fold(of: int) -> Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(of))


@query("op9_toxicity")
def _op9(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    model = fit_toxicity(docs, table(spark, sf, "labels").where(fold(4) != 2))
    return score_toxicity(docs, model).select("doc_id", (fold(4) == 2).alias("held_out"), "score", "predicted")


_RUNS = r"""
SELECT {id}, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
                         WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS x
FROM (SELECT {id}, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
      FROM {table})
"""


@query(
    "op3_decontamination",
    # Holds for items of five words or more, and for shorter ones that are a whole document.
    f"""
WITH d AS (SELECT DISTINCT * FROM ({_RUNS.format(id="doc_id", table="documents")})),
     i AS (SELECT DISTINCT * FROM ({_RUNS.format(id="item_id", table="benchmark")})),
     n AS (SELECT item_id, count(*) AS n_item FROM i GROUP BY item_id)
SELECT doc_id, item_id, count(*) AS n_common, n_item, count(*) / n_item AS containment
FROM d JOIN i USING (x) JOIN n USING (item_id)
GROUP BY doc_id, item_id, n_item HAVING 100 * count(*) >= 80 * n_item
""",
)
def _op3(spark: SparkSession, sf: str) -> DataFrame:
    return contained_items(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query("op5_pfair_mix")
def _op5(spark: SparkSession, sf: str) -> DataFrame:
    mixed = mix_sources(table(spark, sf, "documents").select("doc_id", "source"))
    return mixed.select("doc_id", "source", "mix_block", "mix_release", "mix_deadline", "mix_slot", "mix_place", "mix_full")


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


END_ID = 2


@query("op10_token_files")
def _op10(spark: SparkSession, sf: str) -> DataFrame:
    path = token_folder(spark)
    write_tokens(table(spark, sf, "documents"), path, vocabulary(), END_ID)
    return read_digests(spark, path)


@query("op8_secret_scan")
def _op8(spark: SparkSession, sf: str) -> DataFrame:
    found = scan_secrets(table(spark, sf, "documents"))
    base = F.filter("spans", lambda s: s["kind"] != "literal")

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    return found.select("doc_id", *[count(k) for k in KINDS], F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


@query("op6_permutation_neighbours")
def _op6(spark: SparkSession, sf: str) -> DataFrame:
    return nearest(table(spark, sf, "embeddings"), F.col("vec_id") % 20 == 0)


@query("op4_quality")
def _op4(spark: SparkSession, sf: str) -> DataFrame:
    described = describe(table(spark, sf, "documents"))
    model = fit_quality(described, table(spark, sf, "labels").where(fold(5) != 0))
    return score_quality(described, model).select("doc_id", (fold(5) == 0).alias("held_out"), "score", "predicted")


@query("op1_substring_dedup")
def _op1(spark: SparkSession, sf: str) -> DataFrame:
    return repeated_passages(table(spark, sf, "documents"))


@query(
    "op2_line_dedup",
    r"""
WITH raw AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS x, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS line FROM documents
), lines AS (
  SELECT doc_id, line, list_sort(list_distinct(regexp_extract_all(translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'))) AS s
  FROM raw
), full_lines AS (SELECT * FROM lines WHERE len(s) > 0),
classes AS (SELECT s, row_number() OVER (ORDER BY s) AS c, min((doc_id, line)) AS first FROM full_lines GROUP BY s),
members AS (SELECT c, len(s) AS n, unnest(s) AS w FROM classes),
pairs AS (
  SELECT a.c AS a, b.c AS b FROM members a JOIN members b ON a.w = b.w AND a.c <> b.c AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY a.c, b.c, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), reached AS (SELECT p.a AS c, count(*) AS n_links, min(k.first) AS near FROM pairs p JOIN classes k ON k.c = p.b GROUP BY p.a),
known AS (SELECT k.s, coalesce(r.n_links, 0) AS n_links, least(k.first, coalesce(r.near, k.first)) AS bound FROM classes k LEFT JOIN reached r USING (c)),
found AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER ((doc_id, line) > bound) AS n_removed, sum(n_links)::BIGINT AS n_links
  FROM full_lines JOIN known USING (s) GROUP BY doc_id
)
SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, coalesce(n_links, 0) AS n_links
FROM documents LEFT JOIN found USING (doc_id)
""",
)
def _op2(spark: SparkSession, sf: str) -> DataFrame:
    return line_summary(table(spark, sf, "documents"))


@query(
    "op11_conversation_trie",
    r"""
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT conv_id, conv_id - conv_id % 20 AS base,
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
             lambda acc, b: list_reduce(list_prepend(xor(acc, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
                                        lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)), 4294967295::BIGINT) % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM turns)
), rebuilt AS (
  SELECT c.conv_id, 0 AS own, t.pos, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.base AND t.pos <= c.h
  UNION ALL SELECT c.conv_id, 1, t.pos, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.pos > c.h
), lists AS (
  SELECT c.conv_id, coalesce(list(md5(r.role) || md5(r.text) ORDER BY r.own, r.pos) FILTER (r.own IS NOT NULL), []) AS s,
         coalesce(list(len(regexp_extract_all(r.text, '[^ 	-]+')) ORDER BY r.own, r.pos) FILTER (r.own IS NOT NULL), []) AS w
  FROM convs c LEFT JOIN rebuilt r ON r.conv_id = c.conv_id GROUP BY c.conv_id
), paths AS (
  SELECT conv_id, d, array_to_string(s[1:d], ',') AS p, array_to_string(s[1:d - 1], ',') AS up, CASE WHEN d = 0 THEN 0 ELSE w[d] END AS words, d = len(s) AS last
  FROM (SELECT *, unnest(range(0, len(s) + 1)) AS d FROM lists)
), nodes AS (
  SELECT d, p, any_value(up) AS up, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (last), '')) AS ends_sha256
  FROM paths GROUP BY d, p
), children AS (
  SELECT n.*, coalesce(c.n_children, 0) AS n_children
  FROM nodes n LEFT JOIN (SELECT d - 1 AS d, up AS p, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY d, up) c USING (d, p)
), below AS (
  SELECT x.d, x.p, sum((u.n_children = 0)::BIGINT)::BIGINT AS n_leaves, sum((u.n_convs - 1) * u.words)::BIGINT AS saved_tokens
  FROM children u JOIN paths x ON x.conv_id = u.conv_id AND x.d <= u.d GROUP BY x.d, x.p
)
SELECT n.conv_id, n.d AS depth, a.conv_id AS parent_conv_id, n.n_convs, n.n_children, b.n_leaves, b.saved_tokens, n.ends_sha256
FROM children n JOIN below b USING (d, p) LEFT JOIN nodes a ON n.d > 0 AND a.d = n.d - 1 AND a.p = n.up
""",
)
def _op11(spark: SparkSession, sf: str) -> DataFrame:
    return prefix_trie(table(spark, sf, "conversations"))


@query("op12_simhash_near_dedup")
def _op12(spark: SparkSession, sf: str) -> DataFrame:
    return simhash_groups(table(spark, sf, "documents"))


def _lloyd_sql() -> str:
    """The rounds one after the other, each comparing everything."""
    nearest = """
a{r} AS MATERIALIZED (
  SELECT vec_id, part, arg_min(entry, (d, entry)) AS entry, min(d) AS d FROM (
    SELECT p.vec_id, p.part, b.entry, list_sum(list_transform(range(1, len(p.v) + 1), lambda i: (p.v[i] - b.v[i]) * (p.v[i] - b.v[i])))::BIGINT AS d
    FROM parts p JOIN b{r} b USING (part)
  ) GROUP BY vec_id, part
)"""
    update = """
m{r} AS (
  SELECT part, entry, list((s - ((s % n) + n) % n) // n ORDER BY i) AS v
  FROM (
    SELECT part, entry, i, sum(x)::BIGINT AS s, count(*) AS n
    FROM (SELECT part, entry, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM parts JOIN a{r} USING (vec_id, part)) GROUP BY part, entry, i
  ) GROUP BY part, entry
), b{n} AS MATERIALIZED (SELECT b.part, b.entry, coalesce(m.v, b.v) AS v FROM b{r} b LEFT JOIN m{r} m USING (part, entry))"""
    steps = [nearest.format(r=0)]
    for r in range(ROUNDS):
        steps += [update.format(r=r, n=r + 1), nearest.format(r=r + 1)]
    return f"""
WITH whole AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS MATERIALIZED (
  SELECT vec_id, part, v[part * len(v) // 4 + 1:(part + 1) * len(v) // 4] AS v FROM whole, (SELECT unnest(range(0, 4)) AS part)
), b0 AS MATERIALIZED (
  SELECT part, entry, v FROM parts JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM whole QUALIFY entry < 256) USING (vec_id)
),{",".join(steps)},
coded AS (SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM a{ROUNDS} GROUP BY vec_id),
books AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b{ROUNDS})
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM coded JOIN whole USING (vec_id), books
"""


@query("op13_vector_codes", _lloyd_sql())
def _op13(spark: SparkSession, sf: str) -> DataFrame:
    return code_report(table(spark, sf, "embeddings"))


QUERIES, SQL = registry.QUERIES, registry.SQL
