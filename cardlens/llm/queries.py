"""One query per training-data operator, over whole tables, and the SQL of those that SQL can express."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlens.llm import ann, conversations, editprint, mixing, packing, phrases, pii, quality, secrets, simhash, toxicity, urlrules, warc
from cardlens.llm import pipeline as corpus
from cardlens.llm.common import read_table


def joined(spans: Column) -> Column:
    """kind:start:end, comma-joined in the order given."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_of(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(read_table(spark, sf_dir, "documents"))
    order = F.transform(F.concat("base", "added"), lambda s: F.struct(s["start"].alias("start"), F.array_position(F.array(*map(F.lit, ("assign", "access", "hex", "guess"))), s["kind"]).alias("o"), s["kind"].alias("kind"), s["end"].alias("end")))
    return found.select(
        "doc_id",
        *[count_of("base", k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
        joined(F.array_sort(order)).alias("spans"),
        "guess_log10",
    )


def op2_edit_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return editprint.edit_fingerprints(read_table(spark, sf_dir, "documents"))


def op3_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read_table(spark, sf_dir, "documents"))


def op4_multi_index_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(read_table(spark, sf_dir, "embeddings"))


def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(read_table(spark, sf_dir, "documents"))
    spans = F.concat(F.transform("base", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))), "learned")
    return found.select(
        "doc_id",
        *[count_of("base", k).alias(f"n_{k}") for k in pii.PATTERNS],
        F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
        joined(spans).alias("spans"),
    )


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return toxicity.score_documents(docs, toxicity.fit(docs, read_table(spark, sf_dir, "labels")))


def op7_warc_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(read_table(spark, sf_dir, "pages"))


def op8_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def op9_pfair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Targets from 4 to 7 by a sum over the source's name, whatever its count."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source")
    return mixing.schedule(docs, {k: 4.0 + zlib.crc32(str(k).encode()) % 4 for k in mixing.counted_weights(docs)})


def op10_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlrules.judge(read_table(spark, sf_dir, "pages"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(read_table(spark, sf_dir, "documents"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair(read_table(spark, sf_dir, "conversations"))


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (op1_secret_scan, op2_edit_fingerprint, op3_pack_sequences, op4_multi_index_neighbours, op5_personal_data, op6_toxicity, op7_warc_salvage, op8_simhash_components, op9_pfair_mix, op10_url_rules, op11_collocations, op12_conversation_repair, op13_quality_rules, pipeline)
    return {f.__name__: f for f in own}


OP7_SQL = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), g AS (
  SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first FROM p
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first = page_id THEN NULL ELSE first END AS refers_to
FROM g
"""

OP10_SQL = r"""
WITH u AS (
  SELECT page_id, CASE WHEN url IS NULL OR strpos(url, '://') = 0 THEN NULL ELSE substr(url, strpos(url, '://') + 3) END AS rest,
    substr(url, 1, strpos(url, '://') + 2) AS scheme FROM pages
), s AS (
  SELECT page_id, scheme, rest, coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM u
), r(rule_host, rule_path, action) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), fit AS (
  SELECT page_id, max_by(rule_host || rule_path, length(rule_host || rule_path)) AS rule, max_by(action, length(rule_host || rule_path)) AS action
  FROM s JOIN r ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY page_id
), m AS (
  SELECT page_id, lower(scheme || host || substr(rest, length(host) + 1)) AS plain FROM s WHERE rest IS NOT NULL
), v AS (
  SELECT page_id, list_sort(list_filter([
    CASE WHEN regexp_matches(plain, '^[^/]*//(?:[^/?#]*\.)?spam-farm\.') THEN '^[^/]*//(?:[^/?#]*\.)?spam-farm\.' END,
    CASE WHEN regexp_matches(plain, '[?&]sessionid=[0-9a-z]{8,}') THEN '[?&]sessionid=[0-9a-z]{8,}' END,
    CASE WHEN regexp_matches(plain, '^[^/]*//(?:[^/?#]*\.)?(?:[a-z0-9]+-)?casino(?:-[a-z0-9]+)?\.') THEN '^[^/]*//(?:[^/?#]*\.)?(?:[a-z0-9]+-)?casino(?:-[a-z0-9]+)?\.' END,
    CASE WHEN regexp_matches(plain, '/(?:wp-login|xmlrpc)\.php(?:[?#]|$)') THEN '/(?:wp-login|xmlrpc)\.php(?:[?#]|$)' END
  ], lambda x: x IS NOT NULL))[1] AS blocked, regexp_matches(plain, '/robots\.txt$') AS allowed FROM m
)
SELECT s.page_id, s.host, s.path, fit.rule,
  CASE WHEN fit.rule IS NOT NULL THEN fit.action WHEN v.blocked IS NOT NULL AND NOT v.allowed THEN 'block' ELSE 'allow' END AS verdict,
  CASE WHEN fit.rule IS NULL AND NOT v.allowed THEN v.blocked END AS pattern
FROM s LEFT JOIN fit USING (page_id) LEFT JOIN v USING (page_id)
"""


OP11_SQL = r"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS doc, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
), p AS (
  SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM d
), w AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM p
), g AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase FROM (
    SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (SELECT unnest([1, 2, 3, 4, 5]) AS k) WHERE len(w) >= k)
), f AS (
  SELECT lang, phrase, k, count(*)::HUGEINT AS a FROM g GROUP BY ALL HAVING count(*) >= 100
), n AS (
  SELECT lang, sum(len(w))::HUGEINT AS n FROM w GROUP BY lang
), c AS (
  SELECT lang, phrase, k, a, string_split(phrase, ' ') AS w FROM f WHERE k > 1
), cuts AS (
  SELECT lang, phrase, a, j, array_to_string(w[1:j], ' ') AS x, array_to_string(w[j + 1:], ' ') AS y FROM (SELECT *, unnest(range(1, k)) AS j FROM c)
), s AS (
  SELECT cuts.lang, cuts.phrase, cuts.a, x.a AS l, y.a AS r, n.n, j, (1000 * cuts.a * n.n) // (x.a * y.a) AS score
  FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = cuts.x JOIN f y ON y.lang = cuts.lang AND y.phrase = cuts.y JOIN n ON n.lang = cuts.lang
), low AS (
  SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1
), inner_parts AS (
  SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(a) AS longer FROM (
    SELECT lang, w, a, k, m, unnest(range(1, k - m + 2)) AS i FROM c, (SELECT unnest([2, 3, 4]) AS m) WHERE m < k) GROUP BY ALL
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM low LEFT JOIN inner_parts USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 100 * a
QUALIFY rank <= 2000
"""


OP12_SQL = r"""
WITH RECURSIVE crc_table AS (
  SELECT list(list_reduce(range(8), lambda c, _: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, i) ORDER BY i) AS t FROM (SELECT unnest(range(256)) AS i)
), numbered AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda x: ascii(x)::BIGINT) AS bytes FROM conversations
), fated AS (
  SELECT *, xor(list_reduce(bytes, lambda c, b: xor(t[1 + (xor(c, b) & 255)], c // 256), 4294967295), 4294967295) % 20 AS fate FROM numbered, crc_table
), hurt AS (
  SELECT conv_id, turn, CASE fate WHEN 4 THEN 'user' ELSE role END AS role, CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE fate WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM fated WHERE fate <> 0
), placed AS (
  SELECT *, dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS said FROM hurt
), turns AS (
  SELECT *, left(role, 1) AS initial, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN said > 1 THEN 'duplicate'
    WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE 'fine' END AS fault,
    lag(left(role, 1)) OVER (PARTITION BY c ORDER BY i) AS before FROM placed
), inserts(q, letters, price, lines, q1) AS (
  VALUES ('0', '', 0, '', '0'), ('0', 'I', 5, chr(10) || 'user:', 'u'), ('0', 'II', 10, chr(10) || 'user:' || chr(10) || 'assistant:', 'a'),
    ('s', '', 0, '', 's'), ('s', 'I', 5, chr(10) || 'user:', 'u'), ('s', 'II', 10, chr(10) || 'user:' || chr(10) || 'assistant:', 'a'),
    ('u', '', 0, '', 'u'), ('u', 'I', 5, chr(10) || 'assistant:', 'a'), ('a', '', 0, '', 'a'), ('a', 'I', 5, chr(10) || 'user:', 'u')
), edits(letter, q1, q2) AS (
  VALUES ('D', '0', '0'), ('D', 's', 's'), ('D', 'u', 'u'), ('D', 'a', 'a'), ('K', '0', 's'), ('K', '0', 'u'), ('K', 's', 'u'), ('K', 'u', 'a'), ('K', 'a', 'u'),
    ('R', '0', 'u'), ('R', 's', 'u'), ('R', 'u', 'a'), ('R', 'a', 'u')
), paths AS (
  SELECT DISTINCT c, 0::BIGINT AS i, '0' AS q, 0 AS cost, '' AS audit, '' AS repaired FROM turns
  UNION ALL
  SELECT c, i, q, new_cost, new_audit, new_repaired FROM (
    SELECT t.c, t.i, e.q2 AS q, p.cost + n.price + CASE letter WHEN 'D' THEN 2 WHEN 'R' THEN 1 ELSE 0 END + CASE WHEN letter <> 'D' AND fault = 'truncated' THEN 5 ELSE 0 END AS new_cost,
      p.audit || n.letters || letter AS new_audit,
      p.repaired || n.lines || CASE letter WHEN 'D' THEN '' WHEN 'K' THEN chr(10) || role || ':' || text ELSE chr(10) || CASE e.q2 WHEN 'u' THEN 'user:' ELSE 'assistant:' END || text END AS new_repaired
    FROM paths p JOIN turns t ON t.c = p.c AND t.i = p.i + 1 JOIN inserts n ON n.q = p.q JOIN edits e ON e.q1 = n.q1
    WHERE letter = 'D' OR (fault IN ('fine', 'truncated') AND (letter = 'R' OR initial = e.q2))
    QUALIFY row_number() OVER (PARTITION BY t.c, e.q2 ORDER BY new_cost, new_audit) = 1)
), done AS (
  SELECT p.c, p.cost + CASE q WHEN 's' THEN 10 WHEN 'u' THEN 5 ELSE 0 END AS cost, audit || CASE q WHEN 's' THEN 'II' WHEN 'u' THEN 'I' ELSE '' END AS audit,
    repaired || CASE WHEN q = 's' THEN chr(10) || 'user:' ELSE '' END || CASE WHEN q IN ('s', 'u') THEN chr(10) || 'assistant:' ELSE '' END AS repaired
  FROM paths p JOIN (SELECT c, max(i) AS i FROM turns GROUP BY c) m ON m.c = p.c AND m.i = p.i
  QUALIFY row_number() OVER (PARTITION BY p.c ORDER BY p.cost + CASE q WHEN 's' THEN 10 WHEN 'u' THEN 5 ELSE 0 END, audit || CASE q WHEN 's' THEN 'II' WHEN 'u' THEN 'I' ELSE '' END) = 1
), counts AS (
  SELECT c, conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
    count(*) FILTER (WHERE fault = 'truncated') AS truncated, count(*) FILTER (WHERE i > 1 AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM turns GROUP BY c, conv_id
)
SELECT v.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal,
  coalesce(cost, 0)::BIGINT AS cost, coalesce(audit, '') AS audit, sha256(coalesce(repaired[2:], '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) v LEFT JOIN counts ON counts.conv_id IS NOT DISTINCT FROM v.conv_id LEFT JOIN done ON done.c = counts.c
"""


def oracle_sql() -> dict[str, str]:
    sql = {"op7_warc_salvage": OP7_SQL, "op10_url_rules": OP10_SQL, "op11_collocations": OP11_SQL, "op12_conversation_repair": OP12_SQL}
    if corpus.ORACLE_SQL:
        sql["pipeline"] = corpus.ORACLE_SQL
    return sql
