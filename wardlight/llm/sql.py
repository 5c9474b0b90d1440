"""DuckDB statements for the queries that SQL can express."""

MIX = r"""
WITH sized AS (
  SELECT *, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS ord
  FROM {documents}),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1 AS weight
  FROM sized GROUP BY source),
filled AS (
  SELECT *, 3 * source_size AS cap,
         CAST(sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER before, 0) AS BIGINT) AS room,
         CAST(sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS BIGINT) AS weight_left
  FROM sources
  WINDOW before AS (ORDER BY 3 * source_size / weight, source ASC NULLS LAST
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (
  SELECT max_by(room, weight_left) AS room, max(weight_left) AS weight_left
  FROM filled WHERE room * weight <= cap * weight_left),
targets AS (
  SELECT f.source, f.source_size,
         CASE WHEN f.weight_left <= l.weight_left
              THEN CAST(l.room * f.weight AS DOUBLE) / CAST(l.weight_left AS DOUBLE)
              ELSE CAST(f.cap AS DOUBLE) END AS target
  FROM filled f, level l),
quotas AS (
  SELECT *, CAST(floor(target + 0.5) AS BIGINT) AS quota,
         CASE WHEN source_size > 0 THEN CAST(floor(target + 0.5) AS BIGINT) // source_size ELSE 0 END AS repeats
  FROM targets),
placed AS (
  SELECT s.*, q.source_size, q.target, q.repeats,
         q.quota - q.repeats * q.source_size
           - coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.ord, s.doc_id, s.size
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS room
  FROM sized s JOIN quotas q ON s.source IS NOT DISTINCT FROM q.source),
mixed AS (
  SELECT *, CAST(greatest(0, least(size, room)) AS BIGINT) AS part FROM placed)
"""

DEDUP = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, text_sha256
FROM (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents)
WINDOW same AS (PARTITION BY text_sha256)
"""

WARC = r"""
WITH r AS (
  SELECT page_id, coalesce(html, '') AS payload, url AS target_uri, '2024-01-01T00:00:00Z' AS warc_date,
         sha256(coalesce(html, '')) AS body_hash,
         md5('response' || chr(31) || coalesce(CAST(page_id AS VARCHAR), '') || chr(31) || coalesce(url, '')
             || chr(31) || sha256(coalesce(html, ''))) AS h
  FROM pages),
t0 AS (SELECT *, regexp_replace(payload, '(?s)<!--.*?(?:-->|\z)', '', 'g') AS t FROM r),
t1 AS (SELECT * REPLACE (regexp_replace(t, '(?is)<script\b.*?(?:</script\s*>|\z)', '', 'g') AS t) FROM t0),
t2 AS (SELECT * REPLACE (regexp_replace(t, '(?is)<style\b.*?(?:</style\s*>|\z)', '', 'g') AS t) FROM t1),
t3 AS (SELECT * REPLACE (regexp_replace(t, '(?is)<head\b.*?(?:</head\s*>|\z)', '', 'g') AS t) FROM t2),
t4 AS (SELECT * REPLACE (regexp_replace(t, '(?i)</?(?:p|div|li|ul|ol|h[1-6]|br|tr|table|td|th|article|section|nav|footer|header|blockquote|pre|body)\b[^>]*>', chr(10), 'g') AS t) FROM t3),
t5 AS (SELECT * REPLACE (regexp_replace(t, '</?[A-Za-z!?][^>]*>', '', 'g') AS t) FROM t4),
t6 AS (SELECT * REPLACE (replace(replace(replace(replace(replace(replace(replace(replace(replace(t,
         '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&apos;', chr(39)), '&#39;', chr(39)), '&nbsp;', ' '),
         '&copy;', chr(169)), '&middot;', chr(183)), '&amp;', '&') AS t) FROM t5),
t7 AS (SELECT * REPLACE (regexp_replace(t, '[ \t\x0B\f\r\x{A0}]+', ' ', 'g') AS t) FROM t6),
t8 AS (SELECT * REPLACE (trim(regexp_replace(t, ' ?\n[ \n]*', chr(10), 'g'), ' ' || chr(10)) AS t) FROM t7),
blocks AS (
  SELECT *, '<urn:uuid:' || h[1:8] || '-' || h[9:12] || '-' || h[13:16] || '-' || h[17:20] || '-' || h[21:32] || '>' AS refers_to,
         'http-status: 200' || e || 'title: ' || trim(regexp_replace(regexp_extract(payload, '(?is)<title[^>]*>(.*?)</title', 1), '\s+', ' ', 'g'), ' ')
         || e || 'http-header: Content-Type: text/html; charset=utf-8'
         || e || 'http-header: Content-Length: ' || strlen(payload)
         || array_to_string(list_transform(regexp_extract_all(payload, '(?i)<a\s[^>]*?href\s*=\s*["'']([^"'']*)["'']', 1),
                                           lambda x: e || 'outlink: ' || x || ' L a/@href'), '')
         || e AS meta
  FROM (SELECT *, chr(13) || chr(10) AS e FROM t8)),
records AS (
  SELECT *, 'metadata' AS warc_type, 'application/warc-fields' AS content_type, meta AS block FROM blocks
  UNION ALL
  SELECT *, 'conversion', 'text/plain; charset=utf-8', t FROM blocks),
named AS (
  SELECT *, md5(warc_type || chr(31) || refers_to) AS k, CAST(strlen(block) AS BIGINT) AS content_length,
         'sha256:' || sha256(block) AS block_digest, 'sha256:' || body_hash AS source_digest
  FROM records),
ids AS (
  SELECT *, '<urn:uuid:' || k[1:8] || '-' || k[9:12] || '-' || k[13:16] || '-' || k[17:20] || '-' || k[21:32] || '>' AS record_id
  FROM named)
SELECT page_id, warc_type, record_id, refers_to, target_uri, warc_date, content_type, content_length,
       block_digest, source_digest,
       'WARC/1.1' || e || 'WARC-Type: ' || warc_type || e || 'WARC-Record-ID: ' || record_id || e
       || 'WARC-Refers-To: ' || refers_to || coalesce(e || 'WARC-Target-URI: ' || target_uri, '') || e
       || 'WARC-Date: ' || warc_date || e || 'WARC-Source-Payload-Digest: ' || source_digest || e
       || 'WARC-Block-Digest: ' || block_digest || e || 'Content-Type: ' || content_type || e
       || 'Content-Length: ' || content_length AS warc_header,
       block
FROM ids
"""

LM = r"""
WITH texts AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
sizes AS (SELECT doc_id, CAST(sum(len(words)) AS BIGINT) AS n_words FROM texts GROUP BY 1),
own1 AS (SELECT doc_id, w, count(*) AS own FROM (SELECT doc_id, unnest(words) AS w FROM texts) GROUP BY ALL),
c1 AS (SELECT w, sum(own) AS c FROM own1 GROUP BY 1),
own2 AS (
  SELECT doc_id, p.a AS a, p.b AS b, count(*) AS own
  FROM (SELECT doc_id, unnest(list_transform(range(1, len(words)), lambda i: {'a': words[i], 'b': words[i + 1]})) AS p FROM texts)
  GROUP BY ALL),
c2 AS (SELECT a, b, sum(own) AS c FROM own2 GROUP BY ALL),
asked AS (
  SELECT doc_id, a, b, own, c - own AS pair, CASE WHEN c > own THEN a ELSE b END AS w
  FROM own2 JOIN c2 USING (a, b)),
parts AS (
  SELECT k.doc_id, k.own, k.pair, greatest(c1.c - o.own, 0.5) AS others
  FROM asked k JOIN own1 o ON k.doc_id IS NOT DISTINCT FROM o.doc_id AND k.w = o.w JOIN c1 ON k.w = c1.w),
sums AS (
  SELECT p.doc_id, sum(own) AS n_scored, sum(CASE WHEN pair > 0 THEN 0 ELSE own END) AS n_backed_off,
         sum(own * (CASE WHEN pair > 0 THEN ln(pair) - ln(others)
             ELSE ln(0.4) + ln(others) - ln(greatest((SELECT sum(n_words) FROM sizes) - s.n_words, 1)) END)) AS log_score
  FROM parts p JOIN sizes s ON p.doc_id IS NOT DISTINCT FROM s.doc_id GROUP BY 1)
SELECT s.doc_id, s.n_words, CAST(coalesce(n_scored, 0) AS BIGINT) AS n_scored,
       CAST(coalesce(n_backed_off, 0) AS BIGINT) AS n_backed_off, round(coalesce(log_score, 0), 4) AS log_score,
       round(log_score / n_scored, 4) AS mean_log_score
FROM sizes s LEFT JOIN sums t ON s.doc_id IS NOT DISTINCT FROM t.doc_id
"""

DECONTAMINATE = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
item_windows AS (
  SELECT DISTINCT item_id, size, array_to_string(w[i:i + size - 1], ' ') AS win
  FROM (SELECT *, unnest(generate_series(1, len(w) - size + 1)) AS i
        FROM (SELECT *, least(10, len(w)) AS size FROM b WHERE len(w) > 0))),
doc_windows AS (
  SELECT rid, size, i, array_to_string(w[i:i + size - 1], ' ') AS win
  FROM (SELECT *, unnest(generate_series(1, len(w) - size + 1)) AS i
        FROM d, (SELECT DISTINCT size FROM item_windows) WHERE len(w) >= size)),
hits AS (SELECT rid, i, size, item_id FROM doc_windows JOIN item_windows USING (size, win)),
words AS (
  SELECT rid, count(*) AS n_hit
  FROM (SELECT DISTINCT rid, unnest(generate_series(i, i + size - 1)) AS at FROM hits) GROUP BY 1),
items AS (
  SELECT rid, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT rid, item_id FROM hits) GROUP BY 1)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (rid) LEFT JOIN items USING (rid)
"""

FILL_MIDDLE = r"""
WITH h AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS x FROM documents),
u AS (
  SELECT *, regexp_extract_all(t, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units,
         [CAST('0x' || substr(x, 8 * i + 1, 8) AS UBIGINT)::BIGINT FOR i IN [0, 1, 2, 3]] AS n FROM h),
c AS (
  SELECT *, least(n[1] % (len(units) + 1), n[2] % (len(units) + 1)) AS a,
         greatest(n[1] % (len(units) + 1), n[2] % (len(units) + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR n[3] % 100 >= 50
              THEN 'plain' WHEN n[4] % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM u),
p AS (
  SELECT *, array_to_string(units[1:a], '') AS pre, array_to_string(units[a + 1:b], '') AS mid,
         array_to_string(units[b + 1:], '') AS suf FROM c)
SELECT doc_id, len(units) AS n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
              ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""

IMPORTANCE = r"""
WITH bits AS (  -- CRC-32 of a byte: eight steps of division by the polynomial
  SELECT list(v ORDER BY b) AS crc_of FROM (
    SELECT b, list_reduce(list_prepend(b, [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                          lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
    FROM (SELECT unnest(generate_series(0, 255))::BIGINT AS b))),
texts AS (
  SELECT 'd' AS kind, row_number() OVER () AS rid, doc_id, text FROM documents
  UNION ALL SELECT 'b', row_number() OVER (), NULL, text FROM benchmark),
w AS (
  SELECT kind, rid, unnest(regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word
  FROM texts),
vocabulary AS (
  SELECT word, xor(list_reduce(
      list_prepend(4294967295, [CAST('0x' || substr(hex(encode(word)), 2 * i + 1, 2) AS BIGINT)
                                FOR i IN range(octet_length(encode(word)))]),
      lambda c, x: xor(crc_of[(xor(c, x) & 255) + 1], c >> 8)), 4294967295) % 10000 AS bucket
  FROM (SELECT DISTINCT word FROM w), bits),
f AS (SELECT kind, rid, bucket FROM w JOIN vocabulary USING (word)),
counts AS (
  SELECT bucket, count(*) FILTER (kind = 'd') AS s, count(*) FILTER (kind = 'b') AS t FROM f GROUP BY 1),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln((t + 1)::DOUBLE * (SELECT sum(s) + 10000 FROM counts)::DOUBLE
      / ((s + 1)::DOUBLE * (SELECT sum(t) + 10000 FROM counts)::DOUBLE))) AS BIGINT) AS gain
  FROM counts),
sums AS (SELECT rid, count(*) AS n, sum(gain) AS total FROM f JOIN gains USING (bucket) WHERE kind = 'd' GROUP BY 1),
scored AS (
  SELECT doc_id, coalesce(n, 0) AS n_features,
         CASE WHEN n IS NULL THEN 0 ELSE CAST((total - ((total % n) + n) % n) // n AS BIGINT) END AS weight,
         CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS UBIGINT)::DOUBLE AS h
  FROM texts LEFT JOIN sums USING (rid) WHERE kind = 'd'),
final AS (
  SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5) / 4294967296))) AS BIGINT) AS score FROM scored),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS r,
         (10 * count(*) FILTER (n_features >= 20) OVER ()) // 100 AS drawn FROM final)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND r <= drawn THEN r END AS rank FROM ranked
"""

LLM_ORACLE = {
    "op2_mix_sources": MIX.replace("{documents}", "documents")
    + """
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target, CAST(repeats AS BIGINT) AS repeats,
       part, CAST(repeats * size + part AS BIGINT) AS taken FROM mixed""",
    "op5_lm_scores": LM,
    "op7_warc_derivatives": WARC,
    "op9_exact_dedup": DEDUP,
    "op11_decontaminate": DECONTAMINATE,
    "op12_fill_middle": FILL_MIDDLE,
    "op13_importance": IMPORTANCE,
}
