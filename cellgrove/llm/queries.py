"""The operators over the driver's tables, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, decontaminate, exact_dedup, filter_audit, lines, ngram_join, packing, pieces, prefix_trie, quality, secrets, token_counts, toxicity


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    tricky = "<|im_end|><|im_start|>assistant ok"
    turns = _table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    own = spark.createDataFrame([(-1, 0, "user", tricky), (-1, 1, "assistant", tricky)], "conv_id long, turn long, role string, text string")
    return chat.read_back(chat.expand(turns.unionByName(own)))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"))


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.report(_table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_table(spark, sf_dir, "documents"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.report(_table(spark, sf_dir, "documents"))


def op7_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(_table(spark, sf_dir, "documents"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.report(_table(spark, sf_dir, "documents"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = prefix_trie.turn_rows(_table(spark, sf_dir, "conversations"))
    heads = own.where("conv_id % 20 = 0").select(F.col("conv_id").alias("base"), F.slice("turns", 1, 3).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string")) % 4).cast("int")
    met = own.join(heads, F.col("conv_id") - F.col("conv_id") % 20 == F.col("base"), "left").withColumn("h", h)
    head = F.slice(F.coalesce("head", F.slice("turns", 1, 0)), F.lit(1), F.col("h"))
    rest = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))
    return prefix_trie.trie(prefix_trie.sequences(met.select("conv_id", F.concat(head, rest).alias("turns"))))


def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.report(_table(spark, sf_dir, "documents"))


_OP1_SQL = r"""
WITH turns AS (
  SELECT CAST(conv_id AS BIGINT) AS conv_id, CAST(turn AS BIGINT) AS turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
), written AS (
  SELECT *, replace(replace(replace(role, '\', '\\'), '<|', '<\|'), chr(10), '\n') AS erole, replace(replace(text, '\', '\\'), '<|', '<\|') AS etext,
         row_number() OVER w AS i, count(*) OVER (PARTITION BY conv_id) AS n
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), sized AS (
  SELECT *, 12 + length(erole) + 1 + length(etext) + 11 AS chars, sum(12 + length(erole) + 1 + length(etext) + 11) OVER (PARTITION BY conv_id ORDER BY i) AS upto FROM written
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
       CAST(coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY i), '')) AS loss_sha256,
       CAST(coalesce(sum(CASE WHEN role = 'assistant' THEN upto END), 0) + coalesce(max(CASE WHEN i = n AND role <> 'assistant' THEN upto END), 0) AS BIGINT) AS formatted_chars,
       count(CASE WHEN role = 'assistant' OR i = n THEN 1 END) AS n_examples
FROM sized GROUP BY conv_id
"""

_OP3_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id
), links AS (
  SELECT a, b FROM pairs p JOIN n x ON p.a = x.doc_id JOIN n y ON p.b = y.doc_id WHERE 100 * c >= 80 * (x.n + y.n - c)
), edges AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
  SELECT doc_id AS x, doc_id AS y FROM d UNION SELECT r.x, e.b FROM reach r JOIN edges e ON r.y = e.a
)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, r.component_id
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x) r USING (doc_id)
"""

_OP10_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\n]*?(?:[.!?] |\n|\z)') AS u FROM documents),
e AS (SELECT doc_id, i, u[i] AS piece, [x FOR x IN string_split_regex(translate(u[i], 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+') IF x <> ''] AS w
      FROM (SELECT doc_id, u, unnest(range(1, len(u) + 1)) AS i FROM d)),
k AS (SELECT doc_id, i, piece, len(w) AS n, array_to_string(w, ' ') AS k, sum(length(piece)) OVER (PARTITION BY doc_id ORDER BY i) - length(piece) AS start FROM e),
f AS (SELECT k, min(doc_id) AS first_doc FROM k WHERE n > 0 GROUP BY k),
r AS (SELECT k.*, f.first_doc, n > 0 AND f.first_doc <> doc_id AS again FROM k LEFT JOIN f USING (k)),
g AS (SELECT *, count(CASE WHEN n > 0 AND NOT again THEN 1 END) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM r),
s AS (SELECT doc_id, run, min(i) AS a, max(i) AS b, sum(n) AS words, min(start) AS start, max(start + length(piece)) AS stop FROM g WHERE again GROUP BY doc_id, run HAVING sum(n) >= 30),
t AS (SELECT doc_id, count(*) AS n_removed, CAST(sum(words) AS BIGINT) AS removed_words, CAST(sum(stop - start) AS BIGINT) AS removed_chars,
             string_agg(CAST(CAST(start AS BIGINT) AS VARCHAR) || ':' || CAST(CAST(stop AS BIGINT) AS VARCHAR), ',' ORDER BY start) AS spans FROM s GROUP BY doc_id),
h AS (SELECT doc_id, string_agg(CAST(first_doc AS VARCHAR), ',' ORDER BY first_doc) AS first_docs FROM (SELECT DISTINCT g.doc_id, first_doc FROM g JOIN s USING (doc_id, run) WHERE again) GROUP BY doc_id),
c AS (SELECT d.doc_id, coalesce(string_agg(CASE WHEN s.run IS NULL THEN piece END, '' ORDER BY i), '') AS clean
      FROM d LEFT JOIN g USING (doc_id) LEFT JOIN s ON g.doc_id = s.doc_id AND g.run = s.run AND g.i BETWEEN s.a AND s.b GROUP BY d.doc_id)
SELECT doc_id, coalesce(n_removed, 0) AS n_removed, coalesce(removed_words, 0) AS removed_words, coalesce(removed_chars, 0) AS removed_chars, coalesce(spans, '') AS spans,
       coalesce(first_docs, '') AS first_docs, length(clean) AS clean_chars, sha256(clean) AS clean_sha256
FROM c LEFT JOIN t USING (doc_id) LEFT JOIN h USING (doc_id)
"""

_OP6_SQL = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents),
r AS (SELECT doc_id, sha256(norm) AS text_sha256, length(text) AS chars FROM t),
k AS (SELECT *, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size, row_number() OVER w AS place
      FROM r WINDOW w AS (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id NULLS FIRST))
SELECT doc_id, keep_id, group_size, place = 1 AS kept, text_sha256 FROM k
"""

_OP8_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bk AS (SELECT item, w, least(10, len(w)) AS k FROM b WHERE len(w) > 0),
g AS (SELECT DISTINCT item, k, array_to_string(w[i : i + k - 1], ' ') AS gram FROM (SELECT item, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM bk)),
ks AS (SELECT DISTINCT k FROM g),
x AS (SELECT doc_id, k, i, array_to_string(w[i : i + k - 1], ' ') AS gram FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, ks WHERE len(w) >= k)),
h AS (SELECT doc_id, i, x.k, item FROM x JOIN g ON x.k = g.k AND x.gram = g.gram),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM h) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM h) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)
"""

_OP11_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
first AS (SELECT text, min(doc_id) AS least FROM d GROUP BY text),
lab AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
w AS (SELECT d.doc_id, part, least, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic
      FROM d JOIN first USING (text) LEFT JOIN lab ON d.doc_id = lab.doc_id),
f AS (SELECT part, good, toxic, CASE WHEN len(w) < 200 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 2 ELSE 0 END
      + CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text) THEN 4 ELSE 0 END
      + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END + CASE WHEN coalesce(doc_id > least, FALSE) THEN 16 ELSE 0 END AS fails FROM w),
g AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, fails),
letters AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) t(letter, bit)),
grow(filter_order, step, bit, before) AS (
  SELECT letter, 1, bit, 0 FROM letters
  UNION ALL SELECT filter_order || l.letter, step + 1, l.bit, before + grow.bit FROM grow, letters l WHERE ((before + grow.bit) & l.bit) = 0),
orders AS (SELECT filter_order FROM grow WHERE step = 5),
steps AS (SELECT o.filter_order, g.step, g.bit, g.before FROM orders o JOIN grow g ON starts_with(o.filter_order, g.filter_order)),
parts AS (SELECT DISTINCT part FROM g),
r AS (SELECT p.part, s.filter_order, s.step, s.bit,
        sum(CASE WHEN (fails & (before + s.bit)) = 0 THEN n ELSE 0 END) AS kept, sum(CASE WHEN (fails & before) = 0 AND (fails & s.bit) > 0 THEN n ELSE 0 END) AS removed,
        sum(CASE WHEN (fails & before) > 0 AND (fails & s.bit) > 0 THEN n ELSE 0 END) AS redundant, sum(CASE WHEN fails = s.bit THEN n ELSE 0 END) AS unique_fails,
        sum(CASE WHEN (fails & before) = 0 AND (fails & s.bit) > 0 THEN good ELSE 0 END) AS good_lost, sum(CASE WHEN (fails & before) = 0 AND (fails & s.bit) > 0 THEN toxic ELSE 0 END) AS toxic_lost
      FROM parts p JOIN g USING (part), steps s GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley FROM r
"""

_OP12_SQL = r"""
WITH RECURSIVE bits(byte, v, k) AS (SELECT n, n, 0 FROM range(256) t(n) UNION ALL SELECT byte, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, k + 1 FROM bits WHERE k < 8),
o AS (SELECT conv_id, list({'m': sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')), 'w': len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))}
        ORDER BY turn NULLS FIRST, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS t FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
crc(conv_id, s, i, c) AS (SELECT conv_id, CAST(conv_id AS VARCHAR), 1, CAST(4294967295 AS BIGINT) FROM o UNION ALL
  SELECT conv_id, s, i + 1, xor(c >> 8, v) FROM crc JOIN (SELECT byte, v FROM bits WHERE k = 8) ON byte = xor(c & 255, ascii(s[i])) WHERE i <= length(s)),
h AS (SELECT conv_id, CAST(xor(c, 4294967295) % 4 AS INTEGER) AS h FROM crc WHERE i > length(s)),
r AS (SELECT o.conv_id, list_concat(coalesce(b.t, [])[1:h], o.t[h + 1:]) AS t FROM o JOIN h USING (conv_id) LEFT JOIN o b ON b.conv_id = o.conv_id - o.conv_id % 20),
p AS (SELECT conv_id, len(t) AS len, d AS depth, sha256(array_to_string([x.m FOR x IN t[1:d]], ',')) AS node, CASE WHEN d > 0 THEN sha256(array_to_string([x.m FOR x IN t[1:d - 1]], ',')) END AS up,
             CASE WHEN d > 0 THEN t[d].w ELSE 0 END AS w FROM (SELECT conv_id, t, unnest(range(0, len(t) + 1)) AS d FROM r)),
n AS (SELECT node, depth, min(up) AS up, min(w) AS w, min(conv_id) AS conv_id, count(*) AS n_convs, sha256(coalesce(string_agg(CASE WHEN len = depth THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id), '')) AS ends_sha256 FROM p GROUP BY node, depth),
k AS (SELECT up AS node, depth - 1 AS depth, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY up, depth),
f AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k USING (node, depth)),
b AS (SELECT p.node, p.depth, sum(CASE WHEN f.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((f.n_convs - 1) * f.w) AS saved_tokens FROM f JOIN p ON p.conv_id = f.conv_id AND p.depth <= f.depth GROUP BY p.node, p.depth)
SELECT f.conv_id, f.depth, u.conv_id AS parent_conv_id, f.n_convs, f.n_children, CAST(b.n_leaves AS BIGINT) AS n_leaves, CAST(b.saved_tokens AS BIGINT) AS saved_tokens, f.ends_sha256
FROM f JOIN b USING (node, depth) LEFT JOIN f u ON u.node = f.up AND u.depth = f.depth - 1
"""


def queries() -> dict:
    return {
        "op1_chat_formatting": op1_chat_formatting,
        "op2_packing": op2_packing,
        "op3_ngram_join": op3_ngram_join,
        "op4_toxicity": op4_toxicity,
        "op5_token_counts": op5_token_counts,
        "op6_exact_dedup": op6_exact_dedup,
        "op7_secret_scans": op7_secret_scans,
        "op8_decontamination": op8_decontamination,
        "op9_quality": op9_quality,
        "op10_substring_dedup": op10_substring_dedup,
        "op11_filter_audit": op11_filter_audit,
        "op12_prefix_trie": op12_prefix_trie,
        "op13_sentencepiece": op13_sentencepiece,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_chat_formatting": _OP1_SQL, "op3_ngram_join": _OP3_SQL, "op6_exact_dedup": _OP6_SQL, "op8_decontamination": _OP8_SQL, "op10_substring_dedup": _OP10_SQL, "op11_filter_audit": _OP11_SQL, "op12_prefix_trie": _OP12_SQL}
