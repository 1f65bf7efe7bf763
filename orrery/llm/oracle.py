"""DuckDB SQL for the queries of :mod:`orrery.llm.queries` that SQL can express."""

_OP1 = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), numbered AS (
  SELECT *, (strlen(text) + 3) // 4 + 4 AS cost, row_number() OVER w - 1 AS i,
    sum((strlen(text) + 3) // 4 + 4) OVER (w ROWS UNBOUNDED PRECEDING) AS upto,
    first_value(role) OVER w = 'system' AS has_sys, first_value((strlen(text) + 3) // 4 + 4) OVER w AS first_cost,
    length(regexp_replace(replace(replace(role, '\', '\\'), chr(10), '\n'), '([<\[])(\\*)(/?(?:s>|INST\]))', '\1\\\2\3', 'g'))
      + length(regexp_replace(text, '([<\[])(\\*)(/?(?:s>|INST\]))', '\1\\\2\3', 'g')) + 10 AS shown
  FROM rows WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), measured AS (
  SELECT *, CASE WHEN has_sys THEN first_cost ELSE 0 END AS sys_cost, has_sys AND i = 0 AS is_sys FROM numbered
), placed AS (
  SELECT *, CASE WHEN is_sys THEN 0 ELSE upto - cost - sys_cost END AS start, CASE WHEN is_sys THEN 0 ELSE cost END AS own,
    greatest(2048 - 256 - sys_cost, 512) AS usable FROM measured
), spanned AS (
  SELECT *, 2 * (start // usable) + CASE WHEN start + own > (start // usable + 1) * usable THEN 1 ELSE 0 END AS span FROM placed
), heads AS (
  SELECT conv_id, span, min(i) AS h, min(start) AS h_start FROM spanned GROUP BY ALL
), repeated AS (
  SELECT sum(r.shown) AS chars, h.conv_id FROM heads h JOIN spanned r ON r.conv_id = h.conv_id
    AND (r.is_sys AND h.h > 0 OR NOT r.is_sys AND r.i < h.h AND r.i >= h.h - 2 AND h.h_start - r.start <= 256) GROUP BY ALL
), whole AS (
  SELECT conv_id, count(*) AS n_turns, sum(shown) AS chars,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
    coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY i), '') AS lost
  FROM spanned GROUP BY conv_id
)
SELECT conv_id, CAST(n_turns AS BIGINT) AS n_turns, turns_sha256, CAST(length(lost) AS BIGINT) AS loss_chars, sha256(lost) AS loss_sha256,
  CAST(whole.chars + coalesce(repeated.chars, 0) AS BIGINT) AS formatted_chars
FROM whole LEFT JOIN repeated USING (conv_id)
"""

_OP3 = r"""
WITH vectors AS (
  SELECT vec_id, min(list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE)))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 GROUP BY vec_id
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored QUALIFY rank <= 5
"""

_OP4 = r"""
WITH docs AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), lines AS (
  SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM docs
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines
), repeated AS (
  SELECT key, max(doc_id) AS top FROM keyed WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), marked AS (
  SELECT keyed.*, top IS NOT NULL AND top <> doc_id AS gone FROM keyed LEFT JOIN repeated USING (key)
)
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines, CAST(count(*) FILTER (gone) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

_OP5 = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: w[i:i + 2]) WHEN len(w) > 0 THEN [w] ELSE [] END) AS s FROM words
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT u, v FROM common JOIN sizes x ON x.doc_id = u JOIN sizes y ON y.doc_id = v WHERE 100 * c >= 85 * (x.n + y.n - c)
), reach(root, doc_id) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT reach.root, links.v FROM reach JOIN links ON links.u = reach.doc_id
), parts AS (
  SELECT doc_id, min(root) AS component_id FROM reach GROUP BY doc_id
)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN parts USING (doc_id) LEFT JOIN sizes USING (doc_id)
"""

# crc32 by half bytes; the 16 remainders are fixed values.
_CRC = """xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(range(1, length({0}) + 1), lambda i: [CAST(ascii(substr({0}, i, 1)) & 15 AS BIGINT), CAST(ascii(substr({0}, i, 1)) >> 4 AS BIGINT)]))),
    lambda c, x: xor([0, 498536548, 997073096, 651767980, 1994146192, 1802195444, 1303535960, 1342533948, 3988292384, 4027552580, 3604390888, 3412177804, 2607071920, 2262029012, 2685067896, 3183342108][CAST(xor(c, x) & 15 AS INTEGER) + 1], c >> 4)), CAST(4294967295 AS BIGINT))"""
_OP11 = f"""
WITH RECURSIVE filled AS (
  SELECT coalesce('=' || conv_id, '') AS cid, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations
), kinds AS (
  SELECT *, {_CRC.format("key")} % 20 AS kind FROM filled
), damaged AS (
  SELECT cid, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
  FROM kinds WHERE kind <> 0
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY cid ORDER BY turn NULLS FIRST, role, text, copy) AS i, left(role, 1) AS letter,
    rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare FROM damaged
), marked AS (
  SELECT *, bare = '' AS blank, bare <> '' AND row_number() OVER (PARTITION BY cid, role, text ORDER BY i) > 1 AS again,
    bare <> '' AND right(bare, 1) NOT IN ('.', '!', '?') AS cut, lag(letter) OVER (PARTITION BY cid ORDER BY i) || letter AS pair FROM numbered
), rows AS (
  SELECT *, blank OR again AS gone, CASE WHEN cut AND NOT again THEN 1 ELSE 0 END AS t FROM marked
), sizes AS (
  SELECT cid, count(*) AS n FROM rows GROUP BY cid
), back(cid, i, f0, f1, f2, f3) AS (
  SELECT cid, n + 1, 0, 4, 2, 0 FROM sizes
  UNION ALL
  SELECT cid, i, least(g0, 2 + least(g2, 2 + g3)), least(g1, 2 + least(g2, 2 + g3)), least(g2, 2 + g3), least(g3, 2 + g2) FROM (
    SELECT cid, i, least(3 + f0, ku, ks) AS g0, least(3 + f1, ku) AS g1, least(3 + f2, ka) AS g2, least(3 + f3, ku) AS g3 FROM (
      SELECT b.cid, r.i, f0, f1, f2, f3, CASE WHEN gone THEN 99999999 WHEN letter = 'u' THEN f2 + t ELSE f2 + t + 2 END AS ku,
        CASE WHEN gone THEN 99999999 WHEN letter = 'a' THEN f3 + t ELSE f3 + t + 2 END AS ka, CASE WHEN NOT gone AND letter = 's' THEN f1 + t ELSE 99999999 END AS ks
      FROM back b JOIN rows r ON r.cid = b.cid AND r.i = b.i - 1))
), ahead AS (
  SELECT cid, i, [f0, f1, f2, f3] AS f FROM back
), walk(cid, i, q, audit, said) AS (
  SELECT cid, 1, 0, '', CAST([] AS VARCHAR[]) FROM sizes
  UNION ALL
  SELECT cid, CASE WHEN edit = 'I' THEN i ELSE i + 1 END, CASE edit WHEN 'D' THEN q WHEN 'K' THEN kq ELSE nq END, audit || edit,
    CASE edit WHEN 'D' THEN said WHEN 'K' THEN list_append(said, role || ':' || text) WHEN 'R' THEN list_append(said, named || ':' || text) ELSE list_append(said, named || ':') END
  FROM (
    SELECT *, CASE WHEN role IS NOT NULL AND 3 + g[q + 1] = f[q + 1] THEN 'D' WHEN 2 + f[nq + 1] = f[q + 1] THEN 'I' WHEN kq IS NOT NULL AND t + g[kq + 1] = f[q + 1] THEN 'K' ELSE 'R' END AS edit
    FROM (
      SELECT w.*, here.f, after.f AS g, r.role, r.text, r.t, CASE WHEN q = 2 THEN 3 ELSE 2 END AS nq, CASE WHEN q = 2 THEN 'assistant' ELSE 'user' END AS named,
        CASE WHEN gone THEN NULL WHEN letter = 's' AND q = 0 THEN 1 WHEN letter = 'u' AND q <> 2 THEN 2 WHEN letter = 'a' AND q = 2 THEN 3 END AS kq
      FROM walk w JOIN ahead here ON here.cid = w.cid AND here.i = w.i LEFT JOIN ahead after ON after.cid = w.cid AND after.i = w.i + 1
        LEFT JOIN rows r ON r.cid = w.cid AND r.i = w.i
      WHERE r.role IS NOT NULL OR q IN (1, 2)))
), done AS (
  SELECT w.cid, audit, said FROM walk w JOIN sizes s ON s.cid = w.cid AND w.i = s.n + 1 WHERE q IN (0, 3)
), counts AS (
  SELECT cid, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (again) AS duplicate,
    count(*) FILTER (t = 1) AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM rows GROUP BY cid
)
SELECT c.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank, CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate,
  CAST(coalesce(truncated, 0) AS BIGINT) AS truncated, CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(f0, 0) AS BIGINT) AS cost,
  coalesce(audit, '') AS audit, sha256(coalesce(array_to_string(said, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, coalesce('=' || conv_id, '') AS cid FROM conversations) c
LEFT JOIN counts USING (cid) LEFT JOIN done USING (cid) LEFT JOIN (SELECT cid, f0 FROM back WHERE i = 1) USING (cid)
"""

ORACLE_SQL: dict[str, str] = {
    "op1_chat_format": _OP1,
    "op3_top_k": _OP3,
    "op4_line_dedup": _OP4,
    "op5_minhash": _OP5,
    "op11_turn_repair": _OP11,
}
