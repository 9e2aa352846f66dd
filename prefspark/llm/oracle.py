"""DuckDB SQL for the registered queries that SQL can express."""


def _permuted_sql(rows: str) -> str:
    """``rows`` (src, b, x, n, side_a, side_b) with x mixed once: three rounds over its two halves, by draws of 32 bits."""
    out = f"SELECT *, x // side_b AS l, x % side_b AS r FROM {rows}"
    draw = "('0x' || substr(md5('{step}:' || {half} || ':42:' || src), 1, 8))::BIGINT"
    for i in range(3):
        out = f"SELECT * REPLACE ((l + {draw.format(step=2 * i, half='r')}) % side_a AS l) FROM ({out})"
        out = f"SELECT * REPLACE ((r + {draw.format(step=2 * i + 1, half='l')}) % side_b AS r) FROM ({out})"
    return f"SELECT src, b, l * side_b + r AS x, n, side_a, side_b FROM ({out})"


#: Sainte-Lague over all quotients, one by one; each seat takes one block of its source's ring of words.
OP7 = f"""
WITH RECURSIVE docs AS (
  SELECT doc_id, coalesce('s' || source, 't') AS src, md5(coalesce(doc_id::VARCHAR, 'null') || ':' || size || ':42') AS draw, size
  FROM (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size FROM documents)
), sources AS (
  SELECT src, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY src) AS pos FROM docs GROUP BY src
), weighed AS (
  SELECT *, (pos - 1) % 3 + 1 AS weight, (3 * source_size)::DOUBLE / ((pos - 1) % 3 + 1) AS ratio,
         (SELECT sum(size) FROM docs)::BIGINT AS total
  FROM sources
), levels AS (
  SELECT *, (total - coalesce((SELECT sum(3 * b.source_size) FROM weighed b WHERE (b.ratio, b.pos) < (a.ratio, a.pos)), 0))::DOUBLE
    / (SELECT sum(b.weight) FROM weighed b WHERE (b.ratio, b.pos) >= (a.ratio, a.pos)) AS level
  FROM weighed a
), aimed AS (
  SELECT *, least((3 * source_size)::DOUBLE,
                  (SELECT level FROM levels WHERE ratio >= level ORDER BY ratio, pos LIMIT 1) * weight) AS target
  FROM levels
), sized AS (
  SELECT *, greatest(1, least(256, floor((SELECT min(target) FROM aimed WHERE target > 0) / 64)))::BIGINT AS block FROM aimed
), quotients AS (
  SELECT src, pos, k, target / (2 * k + 1) AS quotient, floor(total / block + 0.5)::BIGINT AS houses
  FROM sized, LATERAL (SELECT unnest(range(0, floor(total / block + 0.5)::BIGINT)) AS k) WHERE target > 0
), won AS (
  SELECT src, pos, row_number() OVER (ORDER BY quotient DESC, pos, k) AS place, houses FROM quotients
), blocks AS (
  SELECT src, block, ceil(source_size / block)::BIGINT AS n FROM sized WHERE source_size > 0
), shards AS (
  SELECT unnest(range(0, 8)) AS shard
), upto AS (
  SELECT src, shard, least(3 * any_value(n), count(w.place))::BIGINT AS upto
  FROM blocks CROSS JOIN shards
  LEFT JOIN (SELECT src AS won_src, place, houses FROM won) w ON won_src = src AND place <= houses * (shard + 1) // 8
  GROUP BY src, shard
), seats AS (
  SELECT src, shard, unnest(range(coalesce(lag(upto) OVER (PARTITION BY src ORDER BY shard), 0), upto)) AS seat FROM upto
), walk AS (
  {_permuted_sql("(SELECT src, b, b AS x, n, side_a, ceil(n / side_a)::BIGINT AS side_b FROM (SELECT src, n, ceil(sqrt(n))::BIGINT AS side_a, unnest(range(0, n)) AS b FROM blocks))")}
  UNION ALL {_permuted_sql("(SELECT * FROM walk WHERE x >= n)")}
), chosen AS (
  SELECT w.src, w.b, s.shard, count(*) AS times FROM (SELECT * FROM walk WHERE x < n) w JOIN seats s ON s.src = w.src AND s.seat % w.n = w.x GROUP BY ALL
), placed AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY src ORDER BY draw ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS ahead,
         row_number() OVER () AS row_no
  FROM docs JOIN sized USING (src)
), reached AS (
  SELECT row_no, src, size, ahead, block, unnest(range(ahead // block, (ahead + size - 1) // block + 1)) AS b FROM placed WHERE size > 0
), taken AS (
  SELECT row_no, shard, sum((least((r.b + 1) * block, ahead + size) - greatest(r.b * block, ahead)) * times)::BIGINT AS words
  FROM reached r JOIN chosen c ON c.src = r.src AND c.b = r.b GROUP BY row_no, shard
)
SELECT doc_id, size, source_size, target, coalesce(sum(words), 0)::BIGINT AS taken,
       {", ".join(f"coalesce(sum(words) FILTER (shard = {i}), 0)::BIGINT AS shard_{i}" for i in range(8))}
FROM placed LEFT JOIN taken USING (row_no) GROUP BY row_no, doc_id, size, source_size, target
"""

#: All pairs of a label, and reachability by a recursive union.
OP9 = """
WITH RECURSIVE vectors AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
    AND list_bool_or(list_transform(embedding, lambda x: x <> 0))
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM vectors a JOIN vectors b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_dot_product(a.v, b.v) / (sqrt(list_dot_product(a.v, a.v)) * sqrt(list_dot_product(b.v, b.v))) >= 0.98
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), components AS (
  SELECT a, min(b) AS component_id FROM reach GROUP BY a
), counts AS (
  SELECT a, count(*) AS n FROM links GROUP BY a
)
SELECT e.vec_id, coalesce(counts.n, 0)::BIGINT AS n_links, c.component_id, e.vec_id = c.component_id AS kept
FROM embeddings e JOIN components c ON c.a = e.vec_id LEFT JOIN counts ON counts.a = e.vec_id
"""

SQL: dict[str, str] = {"op7_mixing": OP7, "op9_embed_dedup": OP9}


SQL["op11_topk"] = """
WITH v AS (
  SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS w FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.w, c.w) AS BIGINT) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5"""

SQL["op12_fim"] = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, CAST(length(coalesce(text, '')) AS BIGINT) AS n, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents),
u AS (
  SELECT doc_id, t, n, [CAST('0x' || substr(h, 1 + 8 * i, 8) AS BIGINT) FOR i IN [0, 1, 2, 3]] AS h FROM d),
f AS (
  SELECT doc_id, t, n, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b,
         CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h[3] % 100 >= 90 THEN 'plain'
              WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM u),
o AS (
  SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
         CASE form WHEN 'plain' THEN t
              WHEN 'psm' THEN '<P>' || substr(t, 1, a) || '<S>' || substr(t, b + 1) || '<M>' || substr(t, a + 1, b - a)
              ELSE '<S>' || substr(t, b + 1) || '<P>' || substr(t, 1, a) || '<M>' || substr(t, a + 1, b - a) END AS output FROM f),
x AS (
  SELECT *, split_part(split_part(output, '<M>', 1), '<P>', 2) AS after_p, split_part(split_part(output, '<M>', 1), '<S>', 2) AS after_s,
         split_part(output, '<M>', 2) AS middle FROM o)
SELECT doc_id, n, form, prefix_chars, middle_chars, sha256(output) AS output_sha256,
       sha256(CASE form WHEN 'plain' THEN output
                   WHEN 'psm' THEN split_part(after_p, '<S>', 1) || middle || after_s
                   ELSE after_p || middle || split_part(after_s, '<P>', 1) END) AS restored_sha256
FROM x"""


def _merkle_levels(name: str, group: str, levels: int) -> str:
    """CTEs from ``{name}0`` (group, i, h, n: nodes of a tree a group) up: ``{name}r<l>`` the runs, ``{name}<l>`` the nodes."""
    steps = []
    for at in range(levels):
        steps.append(f"""
{name}r{at} AS MATERIALIZED (SELECT {group}, i // 3 AS run, n, list(h ORDER BY i) AS hs FROM {name}{at} GROUP BY {group}, i // 3, n),
{name}{at + 1} AS MATERIALIZED (
  SELECT {group}, run AS i, CASE WHEN n > 1 THEN sha256(array_to_string(hs, '')) ELSE hs[1] END AS h, (n + 2) // 3 AS n FROM {name}r{at})""")
    return ",".join(steps)


def _merkle_folds(name: str, tree: str, first: str, group: str, levels: int) -> str:
    """CTEs that lead rows (doc, group, i, folded, proof) of ``first`` up the tree: the siblings of each level join proof and folded."""
    steps, before = [], first
    for at in range(levels):
        left, right = "array_to_string(hs[:i % 3], '')", "array_to_string(hs[i % 3 + 2:], '')"
        steps.append(f"""
{name}{at} AS MATERIALIZED (
  SELECT d.* EXCLUDE (i, folded, proof), i // 3 AS i, proof || CASE WHEN n > 1 THEN {left} || {right} ELSE '' END AS proof,
         CASE WHEN n > 1 THEN sha256({left} || folded || {right}) ELSE folded END AS folded
  FROM {before} d JOIN {tree}r{at} r ON d.{group} = r.{group} AND d.i // 3 = r.run)""")
        before = f"{name}{at}"
    return ",".join(steps)


def _merkle_field(column: str) -> str:
    return f"coalesce(strlen(CAST({column} AS VARCHAR)) || ':' || {column}, '-')"


def _merkle_leaf(text: str) -> str:
    return "sha256(" + " || ".join(_merkle_field(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


#: CRC-32 of the decimal id, bit by bit (3988292384 is its reversed polynomial, a fixed value); null ids have none.
_CRC = """xor(list_reduce([CASE c WHEN '?' THEN 4294967295 ELSE ord(c) END FOR c IN string_split('?' || CAST(doc_id AS VARCHAR), '')],
  lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, _: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)), 4294967295)"""

#: Levels that the SQL spells out: 3 ** 14 documents of a source and 3 ** 9 sources.
_IN_SOURCE, _OF_SOURCES = 14, 9

SQL["op13_merkle"] = f"""
WITH docs AS MATERIALIZED (
  SELECT doc_id, coalesce('1' || source, '0') AS g, {_merkle_leaf("text")} AS leaf, {_merkle_leaf("replace(text, chr(10), '')")} AS changed FROM documents),
placed AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY g) AS n FROM docs),
s0 AS MATERIALIZED (SELECT g, i, leaf AS h, n FROM placed),{_merkle_levels("s", "g", _IN_SOURCE)},
t AS MATERIALIZED (SELECT g, h, row_number() OVER (ORDER BY CAST(g AS BLOB)) - 1 AS i, count(*) OVER () AS n, 0 AS w FROM s{_IN_SOURCE}),
t0 AS MATERIALIZED (SELECT w, i, h, n FROM t),{_merkle_levels("t", "w", _OF_SOURCES)},
d AS MATERIALIZED (SELECT doc_id, g, leaf, i, CASE WHEN {_CRC} % 2 = 0 THEN changed ELSE leaf END AS folded, '' AS proof FROM placed),{_merkle_folds("f", "s", "d", "g", _IN_SOURCE)},
e AS MATERIALIZED (
  SELECT f.doc_id, f.leaf, t.h AS subroot, t.w, t.i, f.folded, f.proof FROM f{_IN_SOURCE - 1} f JOIN t ON f.g = t.g),{_merkle_folds("k", "t", "e", "w", _OF_SOURCES)}
SELECT doc_id, leaf, subroot, (SELECT h FROM t{_OF_SOURCES}) AS root, sha256(proof) AS proof_sha256, folded AS folded_root,
       folded = (SELECT h FROM t{_OF_SOURCES}) AS verified
FROM k{_OF_SOURCES - 1}"""
