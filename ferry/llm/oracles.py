"""SQL for the queries that SQL can express."""

from __future__ import annotations

OP7 = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS t
  FROM documents
), r AS (
  SELECT doc_id, t, count(*) OVER (PARTITION BY t) AS group_size,
         row_number() OVER w AS place, first_value(doc_id) OVER w AS keep_id
  FROM d WINDOW w AS (PARTITION BY t ORDER BY length(text) DESC, doc_id)
)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(t) AS text_sha256 FROM r
"""


def _jump(shards: int) -> str:
    """Columns of a recursion: one jump per step, for keys that have not landed."""
    k = "((k * 2862933555777941757::HUGEINT + 1::HUGEINT) % 18446744073709551616::HUGEINT)"
    return f"""
  SELECT doc_id, CASE WHEN doc_id < 0 THEN doc_id::HUGEINT + 18446744073709551616::HUGEINT ELSE coalesce(doc_id, 0)::HUGEINT END AS k,
         -1::BIGINT AS b, 0::BIGINT AS j FROM ids
  UNION ALL
  SELECT doc_id, {k}, j,
         floor((j + 1)::DOUBLE * (2147483648.0::DOUBLE / (({k} // 8589934592::HUGEINT)::BIGINT + 1)::DOUBLE))::BIGINT
  FROM jump{shards} WHERE j < {shards}
"""


OP3 = f"""
WITH RECURSIVE ids AS (SELECT DISTINCT doc_id FROM documents),
jump40 AS ({_jump(40)}), jump41 AS ({_jump(41)}),
s40 AS (SELECT doc_id, b::INT AS shard FROM jump40 WHERE j >= 40),
s41 AS (SELECT doc_id, b::INT AS grown_shard FROM jump41 WHERE j >= 41),
c(n, v) AS (
  SELECT i, list_reduce(list_prepend(i, range(8)::BIGINT[]), lambda a, x: xor(a >> 1, CASE WHEN a & 1 = 1 THEN 3988292384 ELSE 0 END))
  FROM range(256) r(i)
),
crctable AS (SELECT list(v ORDER BY n) AS t FROM c),
d AS (
  SELECT doc_id, strlen(coalesce(text, '')) + 16 AS size,
         xor(list_reduce(list_prepend(4294967295::BIGINT, [('0x' || h)::BIGINT FOR h IN regexp_extract_all(hex(encode(coalesce(text, ''))), '..')]),
             lambda a, x: xor(a >> 8, t[xor(a, x) % 256 + 1])), 4294967295::BIGINT) AS text_crc32
  FROM documents, crctable
)
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, text_crc32, size) - 1 AS slot, grown_shard
FROM d JOIN s40 USING (doc_id) JOIN s41 USING (doc_id)
"""


WORDS = r"""list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"""

OP2 = f"""
WITH given(base, label, txt, phr) AS (VALUES
  (true, 'cc-by', 'cc by', 'cc by'),
  (true, 'gpl', 'general public license', 'general public license'),
  (true, 'reserved', 'all rights reserved', 'all rights reserved'),
  (false, 'apache-2.0', 'licensed under the apache license version 2 0', 'apache license version 2 0'),
  (false, 'mit', 'released under the mit license', 'mit license'),
  (false, 'mit', 'permission is hereby granted free of charge to any person obtaining a copy', 'permission is hereby granted free of charge'),
  (false, 'bsd', 'redistribution and use in source and binary forms with or without modification are permitted', 'redistribution and use in source and binary forms'),
  (false, 'gpl-2.0', 'gnu general public license version 2', 'general public license version 2'),
  (false, 'gpl-3.0', 'gnu general public license version 3', 'general public license version 3'),
  (false, 'lgpl', 'gnu lesser general public license', 'lesser general public license'),
  (false, 'mpl-2.0', 'subject to the terms of the mozilla public license v 2 0', 'mozilla public license'),
  (false, 'isc', 'permission to use copy modify and or distribute this software for any purpose', 'permission to use copy modify and or distribute'),
  (false, 'unlicense', 'this is free and unencumbered software released into the public domain', 'free and unencumbered software')
), t AS (
  SELECT row_number() OVER () AS k, base, label, string_split(txt, ' ') AS tw, string_split(phr, ' ') AS pw,
         len(string_split(split_part(txt, phr, 1), ' ')) - 1 AS before
  FROM given
), d AS (SELECT row_number() OVER () AS rid, doc_id, {WORDS} AS w FROM documents
), vocab AS (SELECT DISTINCT unnest(tw) AS v FROM t
), idf AS (
  SELECT v, ln(((SELECT count(*) FROM d) + 1.0) / (count(rid) + 1.0)) + 1 AS x
  FROM vocab LEFT JOIN (SELECT DISTINCT rid, unnest(w) AS v FROM d) USING (v) GROUP BY v
), whole AS (SELECT k, sum(x) AS total FROM (SELECT k, unnest(tw) AS v FROM t) JOIN idf USING (v) GROUP BY k
), hit AS (
  SELECT rid, k, unnest(list_filter(range(len(w)), lambda i: w[i + 1 : i + len(pw)] = pw)) AS p FROM d, t WHERE list_contains(w, pw[1])
), covered AS (
  SELECT rid, k, p, sum(x) AS found
  FROM (SELECT rid, k, p, unnest(list_transform(range(len(tw)),
          lambda i: CASE WHEN p + i - before >= 0 AND w[p + i - before + 1] = tw[i + 1] THEN tw[i + 1] END)) AS v
        FROM hit JOIN d USING (rid) JOIN t USING (k))
  JOIN idf USING (v) GROUP BY rid, k, p
), best AS (SELECT rid, k, max(found / total) AS cover FROM covered JOIN whole USING (k) GROUP BY rid, k HAVING max(found / total) >= 0.6
), labelled AS (
  SELECT rid, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, round(least(max(cover), 1.0), 6) AS score
  FROM best JOIN t USING (k) GROUP BY rid
), plain AS (
  SELECT rid, count(*) AS n_base, min(p) AS first_word, max(p) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels
  FROM hit JOIN t USING (k) WHERE base GROUP BY rid
)
SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score
FROM d LEFT JOIN plain USING (rid) LEFT JOIN labelled USING (rid)
"""

OP4 = f"""
WITH d AS (SELECT doc_id, {WORDS} AS w FROM documents),
b AS (SELECT item_id, {WORDS} AS tw FROM benchmark),
dw AS (SELECT doc_id, unnest(w) AS v, generate_subscripts(w, 1) - 1 AS p FROM d),
bw AS (SELECT item_id, len(tw) AS n, unnest(tw) AS v, generate_subscripts(tw, 1) - 1 AS q FROM b),
c AS (
  SELECT doc_id, item_id, p - q AS start_word, count(*) AS same_words
  FROM dw JOIN bw USING (v) GROUP BY 1, 2, 3
  HAVING count(*) >= CASE WHEN any_value(n) < 5 THEN any_value(n) WHEN any_value(n) < 13 THEN any_value(n) - 1 ELSE 11 END
), m AS (
  SELECT c.*, len(tw) AS n, list_prepend(-1, list_concat(
           list_filter(range(len(tw)), lambda i: NOT coalesce(start_word + i >= 0 AND w[start_word + i + 1] = tw[i + 1], false)),
           [len(tw), len(tw), len(tw)])) AS cuts
  FROM c JOIN d USING (doc_id) JOIN b USING (item_id)
), s AS (
  SELECT *, list_max(list_transform(range(1, len(cuts) - 2), lambda i: cuts[i + 3] - cuts[i] - 1)) AS overlap_words FROM m
), f AS (SELECT * FROM s WHERE n < 13 OR overlap_words >= 13
)
SELECT DISTINCT ON (doc_id, item_id) doc_id, item_id, start_word, overlap_words, same_words,
       count(*) OVER (PARTITION BY doc_id, item_id) AS alignments, n < 5 AS phrase
FROM f ORDER BY doc_id, item_id, overlap_words DESC, same_words DESC, start_word
"""

OP9 = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, text, string_split(text, chr(10)) AS ls FROM documents),
l AS (SELECT source, trim(unnest(ls), ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS line FROM d),
bad AS (SELECT coalesce(list(line), []) AS gone FROM (
  SELECT line FROM l WHERE line <> '' GROUP BY line HAVING count(DISTINCT coalesce(source, chr(0))) >= 10)),
k AS (SELECT *, list_filter(ls, lambda x: NOT list_contains(gone, trim(x, ' ' || chr(9) || chr(11) || chr(12) || chr(13)))) AS kept FROM d, bad)
SELECT doc_id, CASE WHEN text IS NULL OR len(kept) = len(ls) THEN text ELSE array_to_string(kept, chr(10)) END AS text,
       coalesce(len(ls), 1) AS n_lines, coalesce(len(ls) - len(kept), 0) AS n_removed
FROM k
"""

# For tables whose ids do not repeat, as the given ones.
OP11 = f"""
WITH c(n, v) AS (
  SELECT i, list_reduce(list_prepend(i, range(8)::BIGINT[]), lambda a, x: xor(a >> 1, CASE WHEN a & 1 = 1 THEN 3988292384 ELSE 0 END))
  FROM range(256) r(i)
), crctable AS (SELECT list(v ORDER BY n) AS t FROM c
), k AS (SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n FROM documents
), e AS (
  SELECT doc_id, text, n, coalesce(lead(doc_id) OVER w, max(doc_id) OVER ()) AS next_id,
         left(text, n - n // 3) || left(coalesce(lead(text) OVER w, first_value(text) OVER w), n // 3) AS edited
  FROM k WINDOW w AS (ORDER BY doc_id DESC)
), t AS (
  SELECT doc_id, false AS changed, {WORDS} AS w FROM e
  UNION ALL SELECT doc_id, true, {WORDS.replace('text', 'edited')} FROM e
), vocab AS (SELECT DISTINCT unnest(w) AS v FROM t
), crc AS (
  SELECT v, xor(list_reduce(list_prepend(4294967295::BIGINT, [('0x' || h)::BIGINT FOR h IN regexp_extract_all(hex(encode(v)), '..')]),
         lambda a, x: xor(a >> 8, t[xor(a, x) % 256 + 1])), 4294967295::BIGINT) AS code
  FROM vocab, crctable
), coded AS (
  SELECT doc_id, changed, list(code ORDER BY p) AS w
  FROM (SELECT doc_id, changed, unnest(w) AS v, generate_subscripts(w, 1) AS p FROM t) JOIN crc USING (v) GROUP BY ALL
), s AS (
  SELECT doc_id, changed, coalesce(len(w), 0) < 69 AS whole,
         list_transform(range(CASE WHEN w IS NULL THEN 0 ELSE greatest(len(w) - 4, 1) END), lambda i: (w[i + 1] * 203445013 + coalesce(w[i + 2], 0) * 251174521
           + coalesce(w[i + 3], 0) * 167870539 + coalesce(w[i + 4], 0) * 229648847 + coalesce(w[i + 5], 0) * 184230161) % 72057594037927931) AS h
  FROM (SELECT doc_id, changed FROM t) LEFT JOIN coded USING (doc_id, changed)
), f AS (
  SELECT doc_id, changed, whole, list_sort(list_distinct(list_filter(h, lambda x: whole OR x < 9007199254740991))) AS h FROM s
), p AS (
  SELECT e.doc_id, e.n, e.edited, o.whole AS ow, o.h AS oh, c.whole AS cw, c.h AS ch, x.whole AS xw, x.h AS xh
  FROM e JOIN f o ON o.doc_id = e.doc_id AND NOT o.changed JOIN f c ON c.doc_id = e.doc_id AND c.changed
  JOIN f x ON x.doc_id = e.next_id AND NOT x.changed
), y AS (
  SELECT *, list_filter(oh, lambda i: cw OR NOT ow OR i < 9007199254740991) AS oc, list_filter(ch, lambda i: ow OR NOT cw OR i < 9007199254740991) AS co,
         list_filter(oh, lambda i: xw OR NOT ow OR i < 9007199254740991) AS ox, list_filter(xh, lambda i: ow OR NOT xw OR i < 9007199254740991) AS xo
  FROM p
), z AS (
  SELECT *, len(list_distinct(list_concat(oc, co))) AS uc, len(list_distinct(list_concat(ox, xo))) AS ux FROM y
)
SELECT doc_id, n AS n_chars, sha256(edited) AS edited_sha256,
       CASE WHEN ow THEN '1:' ELSE '8:' END || array_to_string([printf('%014x', i) FOR i IN oh], '') AS fingerprint,
       CASE WHEN cw THEN '1:' ELSE '8:' END || array_to_string([printf('%014x', i) FOR i IN ch], '') AS edited_fingerprint,
       CASE WHEN uc > 0 THEN (len(oc) + len(co) - uc)::DOUBLE / uc WHEN ow AND cw THEN 1.0 ELSE 0.0 END AS near_edited,
       CASE WHEN ux > 0 THEN (len(ox) + len(xo) - ux)::DOUBLE / ux WHEN ow AND xw THEN 1.0 ELSE 0.0 END AS near_next
FROM z
"""

OP12 = r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), l AS (SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic FROM labels GROUP BY doc_id
), f AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, len(w) < 200 AS a,
         100 * len(list_distinct(w)) < 50 * len(w) AS b,
         100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 3 * length(t) AS c,
         regexp_matches(t, '[#$%&*|]') AS d, coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS e
  FROM d LEFT JOIN l USING (doc_id)
), m AS (
  SELECT part, a::INT + 2 * b::INT + 4 * c::INT + 8 * d::INT + 16 * e::INT AS mask, count(*) AS n,
         count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM f GROUP BY ALL
), x(c, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)
), o AS (
  SELECT p.c || q.c || r.c || s.c || t.c AS filter_order, unnest([p.bit, q.bit, r.bit, s.bit, t.bit]) AS bit,
         unnest([0, p.bit, p.bit + q.bit, p.bit + q.bit + r.bit, p.bit + q.bit + r.bit + s.bit]) AS earlier, unnest([1, 2, 3, 4, 5]) AS step
  FROM x p, x q, x r, x s, x t WHERE p.bit + q.bit + r.bit + s.bit + t.bit = 31 AND len(list_distinct([p.c, q.c, r.c, s.c, t.c])) = 5
), s AS (
  SELECT part, filter_order, step, bit,
         coalesce(sum(n) FILTER (mask & (earlier | bit) = 0), 0) AS kept,
         coalesce(sum(n) FILTER (mask & earlier = 0 AND mask & bit > 0), 0) AS removed,
         coalesce(sum(n) FILTER (mask & earlier > 0 AND mask & bit > 0), 0) AS redundant,
         coalesce(sum(n) FILTER (mask = bit), 0) AS unique_fails,
         coalesce(sum(good) FILTER (mask & earlier = 0 AND mask & bit > 0), 0) AS good_lost,
         coalesce(sum(toxic) FILTER (mask & earlier = 0 AND mask & bit > 0), 0) AS toxic_lost
  FROM m, o GROUP BY ALL
)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM s
"""

OP13 = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u,
         sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents
), c AS (
  SELECT *, len(u) AS n, ('0x' || h[1:8])::BIGINT % (len(u) + 1) AS a, ('0x' || h[9:16])::BIGINT % (len(u) + 1) AS b,
         CASE WHEN t = '' OR regexp_matches(t, '<[PSM]>') OR ('0x' || h[17:24])::BIGINT % 100 >= 100 THEN 'plain'
              WHEN ('0x' || h[25:32])::BIGINT % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM d
), p AS (
  SELECT *, array_to_string(u[:least(a, b)], '') AS pre, array_to_string(u[least(a, b) + 1 : greatest(a, b)], '') AS mid,
         array_to_string(u[greatest(a, b) + 1 :], '') AS suf FROM c
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
       sha256(CASE form WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                        WHEN 'spm' THEN '<S>' || suf || '<P>' || pre || '<M>' || mid ELSE t END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""


def llm_oracles() -> dict[str, str]:
    return {
        "op2_license_scan": OP2,
        "op3_sharding": OP3,
        "op4_decontamination": OP4,
        "op7_exact_dedup": OP7,
        "op9_line_dedup": OP9,
        "op11_fingerprints": OP11,
        "op12_filter_audit": OP12,
        "op13_fill_middle": OP13,
    }
