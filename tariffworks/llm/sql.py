"""DuckDB SQL of the operators that SQL can express; strings are compared by 64-bit hashes."""

from __future__ import annotations

from tariffworks.llm import chat, mixing

#: Smallest id reachable by links (a, b, both ways) from each of `nodes` (id).
_REACH = """
reach(id, other) AS (SELECT id, id FROM nodes UNION SELECT reach.id, links.b FROM reach JOIN links ON reach.other = links.a),
found AS (SELECT id, min(other) AS component_id FROM reach GROUP BY id)
"""

VECTORS = f"""
WITH RECURSIVE nodes AS (SELECT vec_id AS id, embedding::DOUBLE[] AS v FROM embeddings),
sound AS (SELECT * FROM nodes WHERE len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
          AND len(list_filter(v, lambda x: x <> 0)) > 0),
links AS (SELECT p.id AS a, q.id AS b FROM sound p JOIN sound q ON p.id <> q.id AND len(p.v) = len(q.v)
          AND list_cosine_similarity(p.v, q.v) >= 0.9),
{_REACH}
SELECT nodes.id AS vec_id, (SELECT count(*) FROM links WHERE a = nodes.id) AS n_links, component_id, nodes.id = component_id AS kept
FROM nodes JOIN found ON nodes.id = found.id
"""

REPEATS = """
WITH texts AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, length(hex(encode(coalesce(text, '')))) // 2 AS n FROM documents),
starts AS (SELECT doc_id, i, hash(substr(h, 2 * i + 1, 100)) AS string FROM (SELECT doc_id, h, unnest(range(0, n - 49)) AS i FROM texts)),
earliest AS (SELECT string, min(doc_id) AS first_id FROM starts GROUP BY string HAVING min(doc_id) < max(doc_id)),
lost AS (SELECT doc_id, i FROM starts JOIN earliest USING (string) WHERE doc_id > first_id),
numbered AS (SELECT doc_id, i, sum(CASE WHEN i - before <= 50 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY i) AS run
             FROM (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM lost)),
spans AS (SELECT doc_id, min(i) AS first, max(i) + 50 AS last FROM numbered GROUP BY doc_id, run),
gaps AS (SELECT doc_id, first, last, coalesce(lag(last) OVER (PARTITION BY doc_id ORDER BY first), 0) AS kept_from FROM spans),
kept AS (SELECT doc_id, sum(last - first) AS n_removed, count(*) AS n_spans, max(last) AS tail,
                string_agg(substr(h, 2 * kept_from + 1, 2 * (first - kept_from)), '' ORDER BY first) AS k
         FROM gaps JOIN texts USING (doc_id) GROUP BY doc_id)
SELECT doc_id, n AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(CASE WHEN k IS NULL THEN h ELSE k || substr(h, 2 * tail + 1) END)) AS kept_sha256
FROM texts LEFT JOIN kept USING (doc_id)
"""

NEAR = f"""
WITH RECURSIVE words AS (
    SELECT doc_id AS id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[^\\x20\\x09-\\x0D]+') AS w
    FROM documents),
sets AS (
    SELECT id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [hash(array_to_string(w, ' '))]
        ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: hash(array_to_string(w[i:i + 4], ' ')))) END AS s
    FROM words),
nodes AS (SELECT id, len(s) AS n FROM sets),
shingles AS (SELECT id, unnest(s) AS shingle FROM sets),
common AS (SELECT p.id AS a, q.id AS b, count(*) AS n FROM shingles p JOIN shingles q ON p.shingle = q.shingle AND p.id <> q.id
           GROUP BY p.id, q.id),
links AS (SELECT a, b FROM common JOIN nodes x ON x.id = a JOIN nodes y ON y.id = b WHERE 100 * common.n >= 75 * (x.n + y.n - common.n)),
{_REACH}
SELECT nodes.id AS doc_id, nodes.n AS n_shingles, component_id, nodes.id = component_id AS kept
FROM nodes JOIN found ON nodes.id = found.id
"""

MIX = f"""
WITH sized AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
           md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || ':{mixing.SEED}') AS key
    FROM documents),
sources AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS no FROM sized GROUP BY source),
weighted AS (SELECT *, [5, 2, 1][(no - 1) % 3 + 1] AS weight, 3 * source_size AS most FROM sources),
stops AS (SELECT *, most / weight AS stop FROM weighted),
levels AS (
    SELECT *, (sum(source_size) OVER () - coalesce(sum(most) OVER (ORDER BY stop, no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / sum(weight) OVER (ORDER BY stop, no ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM stops),
reached AS (SELECT level FROM levels WHERE level <= stop ORDER BY stop, no LIMIT 1),
targets AS (SELECT source, source_size, coalesce(least(CAST(most AS DOUBLE), weight * (SELECT level FROM reached)), CAST(most AS DOUBLE)) AS target
            FROM levels),
placed AS (
    SELECT doc_id, s.source, size, source_size, target, CAST(floor(target) AS BIGINT) AS last,
           CAST(sum(size) OVER (PARTITION BY s.source ORDER BY key, size, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) - size AS start
    FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, source, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(list_sum(list_transform([0, 1, 2], lambda turn: least(turn * source_size + start + size, last)
            - least(turn * source_size + start, last))) AS BIGINT) AS taken
FROM placed
"""

#: Levels of a tree as a recursive query: every 16 consecutive nodes of a tree with more than one.
_LEVELS = """
    SELECT level + 1, tree, place // 16, sha256(string_agg(hash, '' ORDER BY place)), string_agg(hash, '' ORDER BY place)
    FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM {tree}) WHERE n > 1 GROUP BY level, tree, place // 16
"""
_FIELD = "coalesce(strlen(CAST({0} AS VARCHAR)) || ':' || CAST({0} AS VARCHAR), '-')"


def _leaf(text: str) -> str:
    return f"sha256({' || '.join(_FIELD.format(c) for c in ('doc_id', 'source', 'lang', 'n_chars', text))})"


#: crc32 of a decimal number, byte by byte with the table of its polynomial.
_CRC = """xor(list_reduce([4294967295] || list_transform(range(1, strlen(CAST(doc_id AS VARCHAR)) + 1),
    lambda i: ord(substr(CAST(doc_id AS VARCHAR), i, 1))),
    lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1])), 4294967295)"""

MANIFEST = f"""
WITH RECURSIVE crc AS (
    SELECT list(list_reduce([b] || range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY b) AS steps
    FROM (SELECT unnest(range(256)) AS b)),
hashed AS (
    SELECT doc_id, source, {_leaf('text')} AS leaf,
           {_leaf("CASE WHEN " + _CRC + " % 5 = 0 THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END")}
               AS claimed
    FROM documents CROSS JOIN crc),
leaves AS (
    SELECT *, dense_rank() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS tree,
           row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM hashed),
own(level, tree, place, hash, run) AS (
    SELECT 0, tree, place, leaf, CAST(NULL AS VARCHAR) FROM leaves UNION ALL {_LEVELS.format(tree="own")}),
subroots AS (SELECT tree, arg_max(hash, level) AS subroot, max(level) AS height FROM own GROUP BY tree),
joint(level, tree, place, hash, run) AS (
    SELECT 0, -1, tree, subroot, CAST(NULL AS VARCHAR) FROM subroots UNION ALL {_LEVELS.format(tree="joint")}),
climb(nr, tree, spot, proof, folded, step, height) AS (
    SELECT l.tree::HUGEINT * 1000000000000 + l.place, l.tree, l.place, '', claimed, 0, height FROM leaves l JOIN subroots s ON l.tree = s.tree
    UNION ALL
    SELECT nr, c.tree, spot // 16,
           proof || left(run, CAST(64 * (spot % 16) AS BIGINT)) || substr(run, CAST(64 * (spot % 16 + 1) + 1 AS BIGINT)),
           sha256(left(run, CAST(64 * (spot % 16) AS BIGINT)) || folded || substr(run, CAST(64 * (spot % 16 + 1) + 1 AS BIGINT))), step + 1, height
    FROM (SELECT nr, tree, CASE WHEN step = height THEN tree ELSE spot END AS spot, proof, folded, step, height,
                 CASE WHEN step < height THEN tree ELSE -1 END AS up_tree, CASE WHEN step < height THEN step ELSE step - height END + 1 AS up
          FROM climb) c
    JOIN (SELECT * FROM own UNION ALL SELECT * FROM joint) n ON n.tree = up_tree AND n.level = up AND n.place = spot // 16 AND up > 0),
roots AS (SELECT arg_max(hash, level) AS root FROM joint),
done AS (SELECT nr, arg_max(proof, step) AS proof, arg_max(folded, step) AS folded_root FROM climb GROUP BY nr)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded_root, folded_root = root AS verified
FROM leaves l JOIN subroots s ON l.tree = s.tree JOIN done ON nr = l.tree::HUGEINT * 1000000000000 + l.place CROSS JOIN roots
"""

SQL = {
    "op1_product_quantisation": VECTORS,
    "op2_collection_bwt": REPEATS,
    "op3_perspectives": chat.ROTATE_SQL,
    "op6_chosen_path": NEAR,
    "op10_source_schedule": MIX,
    "op13_merkle_manifest": MANIFEST,
}
