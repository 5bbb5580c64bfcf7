"""DuckDB SQL of the queries that SQL can express."""

ORACLE: dict[str, str] = {}

ORACLE["op4_exact_dedup"] = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER w = 1 AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id NULLS LAST)
"""

ORACLE["op2_warc"] = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
h AS (SELECT page_id, sha1(html) AS d, octet_length(encode(html)) AS payload_bytes,
             min(page_id) OVER (PARTITION BY html) AS first FROM p)
SELECT page_id, payload_bytes,
       list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         CAST(('0x' || substr(d, CAST(5 * (i // 4) + 1 AS INT), 5))::INT >> CAST(15 - 5 * (i % 4) AS INT) & 31 AS INT) + 1, 1)),
         'string_agg', '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM h
"""

ORACLE["op9_chat_format"] = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
g AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn) AS turns,
         coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '') AS loss,
         sum(length('<|im_start|>') + length(replace(role, '<|', '<||')) + 1 + length(replace(text, '<|', '<||'))
             + length('<|im_end|>') + 1) AS formatted_chars
  FROM c GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
       CAST(formatted_chars AS BIGINT) AS formatted_chars
FROM g
"""


def merkle_sql(leaf_levels: int = 13, source_levels: int = 7) -> str:
    """Both trees level by level, as far as `leaf_levels` and `source_levels` reach; a tree of one node stays as it is."""

    def leaf(text: str) -> str:
        cells = ("CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text)
        return "sha256(" + " || ".join(f"CASE WHEN {c} IS NULL THEN '-' ELSE octet_length(encode({c})) || ':' || {c} END" for c in cells) + ")"

    ctes = [f"""d AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p,
      count(*) OVER (PARTITION BY source) AS n FROM (SELECT doc_id, source, {leaf('text')} AS leaf,
        CASE WHEN crc % 2 = 0 AND contains(text, chr(10)) THEN {leaf("replace(text, chr(10), '')")} END AS changed
      FROM (SELECT *, {CRC32} AS crc FROM documents)))""",
      "t0 AS (SELECT source AS k, p, leaf AS h, n FROM d)"]

    def tree(name: str, levels: int) -> None:
        for i in range(levels):
            ctes.append(f"""{name}{i}r AS (SELECT k, p // 3 AS g, list(h ORDER BY p) AS hs, any_value(n) AS n FROM {name}{i} GROUP BY 1, 2)""")
            ctes.append(f"""{name}{i + 1} AS (SELECT k, g AS p, CASE WHEN n = 1 THEN hs[1] ELSE sha256(array_to_string(hs, '')) END AS h,
              (n + 2) // 3 AS n FROM {name}{i}r)""")

    def climb(name: str, first: str, levels: int) -> None:
        ctes.append(f"w{name}0 AS ({first})")
        for i in range(levels):
            left, right = "array_to_string(hs[1:w.p % 3], '')", "array_to_string(hs[w.p % 3 + 2:], '')"
            ctes.append(f"""w{name}{i + 1} AS (SELECT w.* REPLACE (w.p // 3 AS p, CASE WHEN n = 1 THEN cur ELSE sha256({left} || cur || {right}) END AS cur,
              proof || {left} || {right} AS proof) FROM w{name}{i} w JOIN {name}{i}r r ON r.k IS NOT DISTINCT FROM w.k AND r.g = w.p // 3)""")

    tree("t", leaf_levels)
    ctes.append(f"""u0 AS (SELECT 0 AS k, row_number() OVER (ORDER BY k NULLS FIRST) - 1 AS p, h, count(*) OVER () AS n, k AS source FROM t{leaf_levels})""")
    tree("u", source_levels)
    climb("t", "SELECT doc_id, source AS k, leaf, coalesce(changed, leaf) AS cur, '' AS proof, p FROM d", leaf_levels)
    climb("u", f"""SELECT doc_id, leaf, cur, proof, 0 AS k, u.p, u.h AS subroot FROM wt{leaf_levels} w
      JOIN u0 u ON u.source IS NOT DISTINCT FROM w.k""", source_levels)
    return "WITH " + ",\n".join(ctes) + f"""
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, cur AS folded_root, cur = root AS verified
FROM wu{source_levels}, (SELECT h AS root FROM u{source_levels})"""


#: Unsigned crc32 of the decimal doc_id, bit by bit: DuckDB has no such function.
CRC32 = """list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
  lambda a, c: list_reduce(list_prepend(xor(a, c), range(8)), lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END))"""
CRC32 = f"xor(CAST({CRC32} AS BIGINT), 4294967295)"

ORACLE["op11_merkle"] = merkle_sql()

_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""
ORACLE["op13_decontamination"] = f"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, {_WORDS} AS ws FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, ws, least(10, len(ws)) AS k
  FROM (SELECT item_id, {_WORDS} AS ws FROM benchmark) WHERE len(ws) > 0),
windows AS (SELECT DISTINCT item, k, array_to_string(ws[i:i + k - 1], ' ') AS w FROM b, unnest(range(1, len(ws) - k + 2)) AS t(i)),
widths AS (SELECT DISTINCT k FROM windows),
places AS (SELECT row, k, i, array_to_string(ws[i:i + k - 1], ' ') AS w FROM d, widths, unnest(range(1, len(ws) - k + 2)) AS t(i)),
hits AS (SELECT row, k, i, item FROM places JOIN windows USING (k, w)),
covered AS (SELECT row, count(DISTINCT i + j) AS n FROM hits, unnest(range(k)) AS t(j) GROUP BY row),
found AS (SELECT row, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT row, item FROM hits) GROUP BY row)
SELECT doc_id, len(ws) AS n_words, coalesce(c.n, 0) AS n_hit, coalesce(f.n, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(c.n, 0) > 0 AS contaminated
FROM d LEFT JOIN covered c USING (row) LEFT JOIN found f USING (row)"""

ORACLE["op12_hard_negatives"] = """
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score
  FROM r AS a, r WHERE a.vec_id % 100 = 0 AND r.vec_id <> a.vec_id),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, positive_score, vec_id AS negative_id, score AS negative_score,
  CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
FROM s JOIN p USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY rank <= 5"""
