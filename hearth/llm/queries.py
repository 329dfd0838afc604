"""Registered queries of the operators, and their SQL where SQL can express them."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth.llm import chat_format, chat_repair, decontaminate, lang_ppm, line_dedup, minhash_bottomk, mixing, multi_index, period_runs, sharding, simhash_gph, suffix_dedup, toxicity
from hearth.llm.common import materialise


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents into 8 shards of equal row counts."""
    docs = table(spark, sf_dir, "documents")
    crc = F.coalesce(F.crc32("text"), F.lit(0).cast("long"))
    slim = docs.select("doc_id", sharding.text_size(F.col("text")).alias("size"), crc.alias("text_crc32"), F.lit("rows").alias("law"))
    placed = sharding.shard(materialise(spark, slim, "shard_rows"), 8, "doc_id", "text_crc32")
    return placed.select("doc_id", "size", "text_crc32", "law", "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the documents outside the held-out quarter."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = lang_ppm.train(docs.where(~lang_ppm.held_out()))
    scored = lang_ppm.identify(docs.select("doc_id", "text", lang_ppm.held_out().alias("held_out")), model)
    return scored.select("doc_id", "held_out", "lang_pred", "score", "bits_per_byte")


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What remains of every document without the 400-byte strings that occur elsewhere; its words in passages of over 50 words that do."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = suffix_dedup.remove_repeats(docs, length=400, words=51)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + (s["end"] - s["start"]))
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"), F.octet_length("kept").cast("long").alias("n_kept"), "n_repeated_words")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the labels outside the held-out fifth."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").where(~toxicity.held_out())
    model = toxicity.train(docs, labels)
    scored = toxicity.score(docs.select("doc_id", "text", toxicity.held_out().alias("held_out")), model)
    predicted = (F.col("score") >= 0.5).cast("int")
    return scored.select("doc_id", "held_out", "score", predicted.alias("predicted"), F.size("toxic_spans").alias("toxic_sentences"))


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Maximal conversations, rendered."""
    return chat_format.format_chats(table(spark, sf_dir, "conversations"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages in every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.scan(docs, table(spark, sf_dir, "benchmark"))
    n_hit = decontaminate.hit_words()
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), decontaminate.contaminated(n_hit, F.col("n_words")).alias("contaminated"),
    )


def op7_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    rows = simhash_gph.cluster(table(spark, sf_dir, "documents"), shingle_words=3, max_distance=2)
    return rows.select("doc_id", simhash_gph.hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words the mix takes of every document."""
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select(F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("size") * F.col("copies")).cast("long").alias("taken"), "source", "rate", "copies")


def op9_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors of every fiftieth vector."""
    return multi_index.search(table(spark, sf_dir, "embeddings"), lambda i: i % 50 == 0, k=5)


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages without the lines that their sites repeat."""
    return line_dedup.drop_boilerplate(table(spark, sf_dir, "pages"), max_ratio=0.3, min_pages=2)


def op11_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document by the Jaccard similarity of its four-word shingles."""
    return minhash_bottomk.cluster(table(spark, sf_dir, "documents"), shingle_words=4, percent=80)


def planted_cycles(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words of a document, a tenth of the documents (by their id's checksum) made periodic from some word on."""
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    n = len(words)
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words in every document, and the document without their repeats."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = period_runs.collapse_runs(docs, min_length=6, min_exponent=4, rewrite=planted_cycles)
    best = period_runs.longest_run(F.col("runs"))
    milli = (F.lit(1000) * best["length"] - F.pmod(F.lit(1000) * best["length"], best["period"])) / best["period"]
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"),
        best["period"].alias("period"), milli.cast("long").alias("exponent_milli"),
        F.sha2(period_runs.run_lines(F.col("runs")), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def damaged_conversations(rows: DataFrame) -> DataFrame:
    """Turns with the faults that a checksum of (conversation, turn) plants; nulls are one space."""
    kind = F.pmod(F.crc32(F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])), F.lit(20))
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), kind.alias("kind")).where("kind != 0").select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of every damaged conversation."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat_repair.repair(damaged_conversations(rows), ids=rows)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    every = (
        op1_sharding, op2_language_id, op3_suffix_dedup, op4_toxicity, op5_chat_format, op6_decontaminate,
        op7_simhash_dedup, op8_mixing, op9_multi_index, op10_line_dedup, op11_minhash_dedup, op12_periodic_runs, op13_conversation_repair,
    )
    return {f.__name__: f for f in every}


#: DuckDB statements over the same tables.
WORD_CLASS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP6_SQL = f"""
WITH dw AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{WORD_CLASS}'), []) AS w FROM documents
), iw AS (
  SELECT item_id, regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{WORD_CLASS}') AS w FROM benchmark WHERE text IS NOT NULL
), win AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS k, array_to_string(w[s : s + least(13, len(w)) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS s FROM iw WHERE len(w) > 0)
), occ AS (
  SELECT d.doc_id, d.s, win.k, win.item_id
  FROM (SELECT doc_id, k, s, array_to_string(w[s : s + k - 1], ' ') AS g
        FROM (SELECT doc_id, w, ks.k, unnest(range(1, len(w) - ks.k + 2)) AS s FROM dw, (SELECT DISTINCT k FROM win) ks WHERE len(w) >= ks.k)) d
  JOIN win ON win.k = d.k AND win.g = d.g
), hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + k)) AS p FROM occ) GROUP BY doc_id
), it AS (
  SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS names FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM occ) GROUP BY doc_id
)
SELECT dw.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)
"""


OP5_SQL = """
WITH t AS (
  SELECT conv_id, turn, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, role NULLS LAST, text NULLS LAST) - 1 AS pos
  FROM (SELECT DISTINCT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL)
), c AS (
  SELECT conv_id, count(*) AS n, list({'r': role, 't': text} ORDER BY pos) AS turns FROM t GROUP BY conv_id
), kept AS (
  SELECT min(conv_id) AS conv_id, n, count(*) AS copies, turns FROM c GROUP BY n, turns
), maximal AS (
  SELECT k.* FROM kept k WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.n > k.n AND c.turns[1 : k.n] = k.turns)
)
SELECT m.conv_id, CAST(pos // 4096 AS INTEGER) AS part, CAST(any_value(m.n) AS BIGINT) AS n_turns, CAST(any_value(m.copies) AS BIGINT) AS copies,
       string_agg('<|' || coalesce(role, 'unknown') || '|>' || chr(10) || coalesce(text, '') || chr(10) || '<|end|>' || chr(10), '' ORDER BY pos) AS chat
FROM maximal m JOIN t ON t.conv_id = m.conv_id GROUP BY m.conv_id, pos // 4096
"""

OP10_SQL = r"""
WITH p AS (
  SELECT row_number() OVER () AS k, page_id, nullif(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1)), '') AS host,
    regexp_replace(regexp_replace(regexp_replace(regexp_replace(coalesce(html, ''),
      '(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->', '', 'g'), '[ \t\r\n\f]+', ' ', 'g'),
      '(?i)</?(?:address|article|aside|blockquote|body|br|dd|div|dl|dt|footer|form|h[1-6]|head|header|hr|html|li|main|nav|ol|p|pre|section|table|td|th|title|tr|ul)\b[^>]*>', chr(10), 'g'),
      '<[^>]*>', '', 'g') AS body
  FROM pages
), l AS (
  SELECT k, page_id, host, list_filter(list_transform(string_split(body, chr(10)), lambda s: trim(regexp_replace(s, ' +', ' ', 'g'))), lambda s: s <> '') AS lines FROM p
), e AS (
  SELECT k, host, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM l
), f AS (
  SELECT host, line FROM (SELECT host, line, count(DISTINCT k) AS n FROM e WHERE host IS NOT NULL GROUP BY host, line)
  JOIN (SELECT host, count(*) AS pages FROM l GROUP BY host) USING (host) WHERE n >= 2 AND n > 0.3 * pages
), kept AS (
  SELECT k, string_agg(line, chr(10) ORDER BY i) AS text, count(*) AS n FROM e WHERE NOT EXISTS (SELECT 1 FROM f WHERE f.host = e.host AND f.line = e.line) GROUP BY k
)
SELECT page_id, host, CAST(len(lines) AS INTEGER) AS n_lines, CAST(len(lines) - coalesce(n, 0) AS INTEGER) AS n_dropped, coalesce(text, '') AS text
FROM l LEFT JOIN kept USING (k)
"""


OP13_SQL = r"""
WITH RECURSIVE src AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations
), crc AS (
  SELECT k, xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(range(1, len(k) + 1), lambda i: [CAST(ascii(k[i]) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, (c & 1) * 3988292384) END)) % 20 AS kind
  FROM (SELECT DISTINCT k FROM src)
), dmg AS (
  SELECT coalesce(CAST(conv_id AS VARCHAR), '') AS ck, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
  FROM src JOIN crc USING (k) WHERE kind <> 0
), pos AS (
  SELECT ck, turn, role, text, row_number() OVER (PARTITION BY ck ORDER BY turn NULLS FIRST, role, text, copy) AS i FROM dmg
), rows AS (
  SELECT *, substr(role, 1, 1) AS r, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'b' WHEN row_number() OVER (PARTITION BY ck, role, text ORDER BY i) > 1 THEN 'd'
    WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 't' ELSE 'o' END AS f, lag(substr(role, 1, 1)) OVER (PARTITION BY ck ORDER BY i) AS before
  FROM pos
), dp AS (
  SELECT ck, CAST(0 AS BIGINT) AS i, {'c': CAST(0 AS BIGINT), 'a': ''} AS z, {'c': CAST(1000000000000 AS BIGINT), 'a': ''} AS s, {'c': CAST(1000000000000 AS BIGINT), 'a': ''} AS u, {'c': CAST(1000000000000 AS BIGINT), 'a': ''} AS a
  FROM (SELECT DISTINCT ck FROM rows)
  UNION ALL
  SELECT ck, i, {'c': z.c + 4, 'a': z.a || 'D'},
    list_min([{'c': s.c + 4, 'a': s.a || 'D'}, {'c': z.c + x + (CASE WHEN r = 's' THEN 0 ELSE 1000000000000 END), 'a': z.a || 'K'}]),
    list_min([{'c': u.c + 4, 'a': u.a || 'D'}, {'c': z.c + x + 3, 'a': z.a || 'R'}, {'c': s.c + x + 3, 'a': s.a || 'R'}, {'c': a.c + x + 3, 'a': a.a || 'R'},
      {'c': z.c + x + ku, 'a': z.a || 'K'}, {'c': s.c + x + ku, 'a': s.a || 'K'}, {'c': a.c + x + ku, 'a': a.a || 'K'}]),
    list_min([{'c': a.c + 4, 'a': a.a || 'D'}, {'c': u.c + x + 3, 'a': u.a || 'R'}, {'c': u.c + x + (CASE WHEN r = 'a' THEN 0 ELSE 1000000000000 END), 'a': u.a || 'K'}])
  FROM (
    SELECT ck, i, r, x, z, s, u, CASE WHEN r = 'u' THEN 0 ELSE 1000000000000 END AS ku, list_min([a, {'c': u.c + 3, 'a': u.a || 'I'}]) AS a
    FROM (
      SELECT dp.ck, n.i, n.r, CASE n.f WHEN 'o' THEN 0 WHEN 't' THEN 3 ELSE 1000000000000 END AS x, dp.z, dp.s, dp.a,
        list_min([dp.u, {'c': dp.z.c + 3, 'a': dp.z.a || 'I'}, {'c': dp.s.c + 3, 'a': dp.s.a || 'I'}, {'c': dp.a.c + 3, 'a': dp.a.a || 'I'}]) AS u
      FROM dp JOIN rows n ON n.ck = dp.ck AND n.i = dp.i + 1))
), fin AS (
  SELECT ck, list_min([z, a, {'c': u.c + 3, 'a': u.a || 'I'}, {'c': s.c + 6, 'a': s.a || 'II'}]) AS best
  FROM dp JOIN (SELECT ck, max(i) AS i FROM rows GROUP BY ck) USING (ck, i)
), letters AS (
  SELECT ck, j, substr(best.a, j, 1) AS e FROM (SELECT ck, best, unnest(range(1, len(best.a) + 1)) AS j FROM fin)
), placed AS (
  SELECT *, CASE WHEN e <> 'I' THEN sum(CAST(e <> 'I' AS INTEGER)) OVER (PARTITION BY ck ORDER BY j) END AS i FROM letters
), out AS (
  SELECT p.ck, p.j, p.e, n.role, coalesce(n.text, '') AS text, row_number() OVER (PARTITION BY p.ck ORDER BY p.j) - first_value(CASE WHEN p.e = 'K' AND n.r = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY p.ck ORDER BY p.j) AS turn
  FROM (SELECT * FROM placed WHERE e <> 'D') p LEFT JOIN rows n ON n.ck = p.ck AND n.i = p.i AND p.e <> 'I'
), said AS (
  SELECT ck, sha256(string_agg(CASE WHEN e = 'K' THEN role WHEN turn % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY j)) AS h FROM out GROUP BY ck
), counted AS (
  SELECT ck, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (f = 'b') AS blank, count(*) FILTER (f = 'd') AS duplicate, count(*) FILTER (f = 't') AS truncated,
    count(*) FILTER (before IS NOT NULL AND before || r NOT IN ('su', 'ua', 'au')) AS illegal FROM rows GROUP BY ck
)
SELECT v.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank, CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
  CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(best.c, 0) AS BIGINT) AS cost, coalesce(best.a, '') AS audit, coalesce(h, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, coalesce(CAST(conv_id AS VARCHAR), '') AS ck FROM conversations) v LEFT JOIN counted USING (ck) LEFT JOIN fin USING (ck) LEFT JOIN said USING (ck)
"""


OP11_SQL = r"""
WITH RECURSIVE w AS (
  SELECT row_number() OVER () AS k, doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w FROM documents
), d AS (
  SELECT k, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_sort(list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i : i + 3], ' ')))) END AS s FROM w
), c AS (
  SELECT min(k) AS c, s, len(s) AS n FROM d GROUP BY s
), t AS (
  SELECT c, n, unnest(s) AS v FROM c
), rare AS (
  SELECT c, n, v, row_number() OVER (PARTITION BY c ORDER BY h, v) AS r FROM (SELECT c, n, v, count(*) OVER (PARTITION BY v) AS h FROM t)
), cand AS (
  SELECT DISTINCT a.c AS a, b.c AS b FROM rare a JOIN rare b ON a.v = b.v AND a.c < b.c AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  WHERE a.r <= a.n - (80 * a.n + 99) // 100 + 1 AND b.r <= b.n - (80 * b.n + 99) // 100 + 1
), link AS (
  SELECT a, b FROM (SELECT a, b, x.n + y.n AS n, len(list_intersect(x.s, y.s)) AS i FROM cand JOIN c x ON x.c = a JOIN c y ON y.c = b) WHERE 100 * i >= 80 * (n - i)
), e AS (
  SELECT a, b FROM link UNION ALL SELECT b, a FROM link
), reach AS (
  SELECT c AS a, c AS b FROM c UNION SELECT reach.a, e.b FROM reach JOIN e ON e.a = reach.b
), named AS (
  SELECT r.a AS c, min(d.doc_id) AS component_id FROM reach r JOIN c x ON x.c = r.b JOIN d ON d.s = x.s GROUP BY r.a
)
SELECT d.doc_id, CAST(len(d.s) AS BIGINT) AS n_shingles, CASE WHEN len(d.s) = 0 THEN d.doc_id ELSE component_id END AS component_id,
  d.doc_id IS NOT DISTINCT FROM (CASE WHEN len(d.s) = 0 THEN d.doc_id ELSE component_id END) AS kept
FROM d JOIN c ON c.s = d.s JOIN named ON named.c = c.c
"""


def oracle_sql() -> dict[str, str]:
    return {"op5_chat_format": OP5_SQL, "op6_decontaminate": OP6_SQL, "op10_line_dedup": OP10_SQL, "op11_minhash_dedup": OP11_SQL, "op13_conversation_repair": OP13_SQL}
