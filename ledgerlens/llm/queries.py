"""The queries of the training-data operators and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, exactdedup, htmltext, licenses, linededup, mixing, neardup, packing, shared, syncmers, toxicity, trie, variants, warc


#: A conversation that holds the template's own marks.
MARKED = (-7, r"\### Assistant: </turn> ok")


def op1_format_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = spark.createDataFrame([(MARKED[0], i, role, MARKED[1]) for i, role in enumerate(("user", "assistant"))], "conv_id long, turn long, role string, text string")
    rows = shared.table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(marked)
    messages = shared.stored(chat.message_chain(rows), "chat-messages")
    names = messages.select("tree", "conv_id").distinct()
    return chat.read_back(chat.format_trees(messages, numbered=True).join(names, "tree"))


def op2_scan_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(shared.table(spark, sf_dir, "documents")).drop("detections")


def op3_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.components(shared.table(spark, sf_dir, "documents"))


def op4_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.fingerprints(shared.table(spark, sf_dir, "documents"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = linededup.dedup_lines(shared.table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("row.doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op6_score_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = shared.table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, shared.table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select("row.doc_id", "severity", "p_clean", "grade", "toxic", "n_features")


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exactdedup.dedup_exact(spark, f"{sf_dir}/documents.parquet").drop("file", "row")


def op8_extract_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extract_pages(shared.table(spark, sf_dir, "pages"))


def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(shared.table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op10_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(shared.table(spark, sf_dir, "documents"))


def op11_archive_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc.archived(shared.table(spark, sf_dir, "pages"))
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "place", "capture")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.spelling_variants(shared.table(spark, sf_dir, "documents"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(trie.rebuilt(shared.table(spark, sf_dir, "conversations")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_format_chats": op1_format_chats,
    "op2_scan_licenses": op2_scan_licenses,
    "op3_near_dup": op3_near_dup,
    "op4_fingerprint": op4_fingerprint,
    "op5_line_dedup": op5_line_dedup,
    "op6_score_toxicity": op6_score_toxicity,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_extract_pages": op8_extract_pages,
    "op9_mix_sources": op9_mix_sources,
    "op10_pack": op10_pack,
    "op11_archive_pages": op11_archive_pages,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_prefix_trie": op13_prefix_trie,
}

ORACLE: dict[str, str] = {
    "op1_format_chats": r"""
WITH marked AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
sized AS (
  SELECT *, length(replace(replace(replace(replace(role, '\', '\\'), '#', '\#'), '</turn', '\</turn'), ':', '\:'))
            + length(replace(replace(replace(text, '\', '\\'), '#', '\#'), '</turn', '\</turn')) + 15 AS written FROM marked)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
       sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn NULLS FIRST, role, text)) AS loss_sha256,
       sum(written)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
""",
    "op7_exact_dedup": r"""
WITH rows AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS text_sha256 FROM documents),
groups AS (
  SELECT text_sha256, arg_min(doc_id, (-n, doc_id)) AS keep_id, count(*) AS group_size FROM rows GROUP BY text_sha256)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM rows JOIN groups USING (text_sha256)
""",
    "op5_line_dedup": r"""
WITH lines AS (
  SELECT doc_id, u.i AS n, u.line,
         translate(regexp_replace(regexp_replace(u.line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i
        FROM documents) u),
keys AS (
  SELECT k, max(doc_id) AS keeper FROM lines WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
judged AS (
  SELECT l.doc_id, l.n, l.line, k.k IS NOT NULL AND l.doc_id <> k.keeper AS gone FROM lines l LEFT JOIN keys k ON l.k = k.k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
""",
    "op11_archive_pages": r"""
WITH bodies AS (
  SELECT page_id, coalesce(html, '') AS body, strlen(coalesce(html, ''))::BIGINT AS payload_bytes,
         regexp_replace(regexp_replace(coalesce(url, ''), '#.*$', '', 's'), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS rest
  FROM pages),
split AS (
  SELECT *, max(page_id) OVER (PARTITION BY body) AS target, regexp_extract(rest, '^[^/?]*') AS host, substr(rest, length(regexp_extract(rest, '^[^/?]*')) + 1) AS tail FROM bodies),
keyed AS (
  SELECT *, array_to_string(list_reverse(string_split(regexp_replace(regexp_replace(translate(host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              ':(80|443)$', ''), '^www[0-9]*[.]', ''), '.')), ',') || ')'
            || CASE WHEN split_part(tail, '?', 1) = '' THEN '/' ELSE split_part(tail, '?', 1) END
            || CASE WHEN strpos(tail, '?') > 0 AND substr(tail, strpos(tail, '?') + 1) <> ''
                    THEN '?' || array_to_string(list_sort(string_split(substr(tail, strpos(tail, '?') + 1), '&')), '&') ELSE '' END AS url_key
  FROM split)
SELECT page_id, payload_bytes, sha1(body) AS payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> target THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> target THEN target END AS refers_to, url_key,
       row_number() OVER (ORDER BY url_key, page_id) - 1 AS place, row_number() OVER (PARTITION BY url_key ORDER BY page_id) AS capture
FROM keyed
""",
    "op12_spelling_variants": r"""
WITH RECURSIVE runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') || ':' || run AS id, run, count(*) AS c
  FROM (SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{C0}-\x{FF}]{6,}')),
                                 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents)
  GROUP BY ALL),
-- CRC-32 bit by bit: a byte (128 and more in two of UTF-8), then eight steps
hashed AS (
  SELECT run, c, xor(list_reduce(list_prepend(4294967295, flatten(list_transform(flatten(list_transform(string_split(id, ''),
           lambda s: CASE WHEN unicode(s) < 128 THEN [unicode(s)::BIGINT] ELSE [192 + (unicode(s) >> 6)::BIGINT, 128 + (unicode(s) & 63)::BIGINT] END)),
           lambda b: [b, -1, -1, -1, -1, -1, -1, -1, -1]))),
         lambda h, b: CASE WHEN b >= 0 THEN xor(h, b) WHEN h & 1 = 1 THEN xor(h >> 1, 3988292384) ELSE h >> 1 END), 4294967295) AS h
  FROM runs),
words AS (
  SELECT word, sum(c)::BIGINT AS n
  FROM (SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word, c FROM hashed)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(c) >= 5),
cut AS (SELECT word, n, p.i AS i, substr(word, 1, p.i - 1) || substr(word, p.i + 1) AS rest FROM words, unnest(range(1, length(word) + 1)) AS p(i)),
pairs AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT cut.word, w.word, w.n FROM cut JOIN words w ON cut.rest = w.word
  UNION SELECT w.word, cut.word, cut.n FROM cut JOIN words w ON cut.rest = w.word),
near AS (SELECT word, count(*) AS n_near, arg_min(other, (-other_n, other)) AS best, max(other_n) AS best_n FROM pairs GROUP BY word),
forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 5 * w.n THEN best END AS form, CASE WHEN best_n >= 5 * w.n THEN best_n END AS form_n
  FROM words w LEFT JOIN near USING (word)),
steps AS (
  SELECT word, word AS at, form AS next FROM forms
  UNION ALL SELECT s.word, f.word, f.form FROM steps s JOIN forms f ON s.next = f.word)
SELECT f.word, f.form, s.at AS root, f.n, f.n_near, f.form_n FROM forms f JOIN steps s ON f.word = s.word AND s.next IS NULL
""",
    "op13_prefix_trie": r"""
WITH turns AS (
  SELECT conv_id, k, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, k) - 1 AS place
  FROM (SELECT conv_id, turn, coalesce(text, '') AS text, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS k FROM conversations)),
-- CRC-32 of the digits, bit by bit
convs AS (
  SELECT conv_id, conv_id - conv_id % 20 AS family,
         xor(list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(coalesce(conv_id::VARCHAR, ''), ''),
               lambda s: CASE WHEN s = '' THEN [0]::BIGINT[] ELSE [unicode(s), -1, -1, -1, -1, -1, -1, -1, -1]::BIGINT[] END))),
             lambda h, b: CASE WHEN b >= 0 THEN xor(h, b) WHEN h & 1 = 1 THEN xor(h >> 1, 3988292384) ELSE h >> 1 END), 4294967295) % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM conversations)),
laid AS (
  SELECT c.conv_id, 0 AS part, place, k, words FROM convs c JOIN turns t ON c.family = t.conv_id AND place < h
  UNION ALL SELECT c.conv_id, 1, place, k, words FROM convs c JOIN turns t ON c.conv_id IS NOT DISTINCT FROM t.conv_id AND place >= h),
paths AS (
  SELECT c.conv_id, coalesce(string_agg(k, '' ORDER BY part, place), '') AS path, list(words ORDER BY part, place) FILTER (k IS NOT NULL) AS words
  FROM convs c LEFT JOIN laid l ON c.conv_id IS NOT DISTINCT FROM l.conv_id GROUP BY c.conv_id),
begun AS (SELECT conv_id, path, d.i AS depth, substr(path, 1, 64 * d.i) AS node, CASE WHEN d.i = 0 THEN 0 ELSE words[d.i] END AS words FROM paths, unnest(range(0, length(path) // 64 + 1)) AS d(i)),
nodes AS (
  SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(words) AS saved,
         sha256(coalesce(string_agg(coalesce(conv_id::VARCHAR, ''), ',' ORDER BY conv_id NULLS LAST) FILTER (path = node), '')) AS ends_sha256
  FROM begun GROUP BY node, depth),
kids AS (SELECT substr(node, 1, 64 * (depth - 1)) AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
sums AS (
  SELECT substr(n.node, 1, 64 * d.i) AS node, sum(saved)::BIGINT AS saved_tokens, count(*) FILTER (kids.node IS NULL) AS n_leaves
  FROM nodes n LEFT JOIN kids ON n.node = kids.node, unnest(range(0, n.depth + 1)) AS d(i) GROUP BY 1)
SELECT n.conv_id, n.depth, u.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children, n_leaves, saved_tokens, n.ends_sha256
FROM nodes n LEFT JOIN nodes u ON n.depth > 0 AND u.node = substr(n.node, 1, 64 * (n.depth - 1)) LEFT JOIN kids ON n.node = kids.node JOIN sums ON n.node = sums.node
""",
    "op9_mix_sources": r"""
WITH sized AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN 'n' ELSE 's' || source END AS k,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h
  FROM documents),
totals AS (
  SELECT k, sum(size)::BIGINT AS source_size, ((row_number() OVER (ORDER BY k = 'n', k) - 1) % 3 + 1)::BIGINT AS w FROM sized GROUP BY k),
levels AS (
  SELECT *, sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER b, 0) AS left_words,
         sum(w) OVER () - coalesce(sum(w) OVER b, 0) AS left_weight
  FROM totals WINDOW b AS (ORDER BY source_size::DOUBLE / w, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
opened AS (SELECT *, 3 * source_size * left_weight > w * left_words AS op FROM levels),
first_open AS (SELECT left_words AS fw, left_weight AS fg FROM opened WHERE op ORDER BY source_size::DOUBLE / w, k LIMIT 1),
targets AS (
  SELECT k, source_size, CASE WHEN op THEN (w * fw)::DOUBLE / fg::DOUBLE ELSE (3 * source_size)::DOUBLE END AS target
  FROM opened LEFT JOIN first_open ON true),
needs AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS rounds FROM targets),
placed AS (
  SELECT s.*, sum(size) OVER (PARTITION BY k ORDER BY h RANGE UNBOUNDED PRECEDING) AS upto, sum(size) OVER (PARTITION BY k, h) AS same FROM sized s)
SELECT p.doc_id, p.size, n.source_size, n.target,
       (p.size * (n.rounds + CASE WHEN p.upto <= n.target - n.rounds * n.source_size THEN 1
         WHEN p.upto - p.same <= n.target - n.rounds * n.source_size
              AND 2 * (n.target - n.rounds * n.source_size - (p.upto - p.same)) >= p.same THEN 1 ELSE 0 END))::BIGINT AS taken
FROM placed p JOIN needs n USING (k)
""",
}
