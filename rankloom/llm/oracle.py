"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x20\x09-\x0D]+"

QUALITY_RULES = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, source AS host, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '{WORD}') AS w
  FROM documents
),
windows AS (
  SELECT r, i, array_to_string(w[i:i + 7], ' ') AS g
  FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) >= 8)
),
repeated AS (
  SELECT r, count(DISTINCT word_at) AS n FROM (
    SELECT r, unnest(range(i, i + 8)) AS word_at FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM windows) WHERE n > 1
  ) GROUP BY r
),
lines AS (
  SELECT r, host, t, line, len(regexp_extract_all(line, '{WORD}')) AS words,
         array_to_string(regexp_extract_all(translate(line, '{UPPER}', '{LOWER}'), '{WORD}'), ' ') AS norm
  FROM (SELECT r, host, t, unnest(string_split(t, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '{WORD}')
),
dups AS (SELECT r, count(*) - count(DISTINCT line) AS n FROM lines GROUP BY r),
texts AS (SELECT host, t, any_value(r) AS r FROM d GROUP BY host, t),
entries AS (SELECT l.host, l.t, l.norm, sum(l.words) AS words FROM lines l JOIN texts x ON x.r = l.r GROUP BY l.host, l.t, l.norm),
hosts AS (SELECT host, count(*) AS n FROM texts GROUP BY host),
often_high AS (
  SELECT e.host, e.norm FROM (SELECT host, norm, count(*) AS n FROM entries GROUP BY host, norm) e
  JOIN hosts h ON h.host IS NOT DISTINCT FROM e.host
  WHERE e.n > 10 AND e.n > CAST(0.1 AS DOUBLE) * h.n
),
low_some AS (
  SELECT e.host, e.norm, h.n AS host_docs FROM (SELECT host, norm, count(*) AS n, min(words) AS words FROM entries GROUP BY host, norm) e
  JOIN hosts h ON h.host IS NOT DISTINCT FROM e.host
  WHERE e.words >= 6 AND e.n >= 3 AND e.n > least(100, CAST(0.02 AS DOUBLE) * h.n)
),
low_held AS (
  SELECT e.host, e.t, e.norm, e.words, s.host_docs FROM entries e JOIN low_some s ON s.host IS NOT DISTINCT FROM e.host AND s.norm = e.norm
),
low_carriers AS (
  SELECT c.host, c.t FROM (SELECT host, t, sum(words) AS words FROM low_held GROUP BY host, t) c
  JOIN texts x ON x.host IS NOT DISTINCT FROM c.host AND x.t = c.t JOIN d ON d.r = x.r
  WHERE 2 * c.words <= len(d.w)
),
often_low AS (
  SELECT e.host, e.norm FROM low_held e JOIN low_carriers c ON c.host IS NOT DISTINCT FROM e.host AND c.t = e.t
  GROUP BY e.host, e.norm, e.host_docs HAVING count(*) >= 3 AND count(*) > least(100, CAST(0.02 AS DOUBLE) * e.host_docs)
),
often AS (SELECT host, norm FROM often_high UNION SELECT host, norm FROM often_low),
removed AS (
  SELECT e.host, e.t, sum(e.words) AS words, count(*) AS n FROM entries e
  JOIN often o ON o.host IS NOT DISTINCT FROM e.host AND o.norm = e.norm GROUP BY e.host, e.t
),
counts AS (
  SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(length(array_to_string(d.w, '')) AS BIGINT) AS word_chars,
         CAST(length(d.t) - length(regexp_replace(d.t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(u.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(p.n, 0) AS BIGINT) AS n_repeat_words,
         CAST(coalesce(m.n, 0) AS BIGINT) AS n_frequent_lines, CAST(coalesce(m.words, 0) AS BIGINT) AS n_line_words
  FROM d LEFT JOIN dups u ON u.r = d.r LEFT JOIN repeated p ON p.r = d.r
  LEFT JOIN removed m ON m.host IS NOT DISTINCT FROM d.host AND m.t = d.t
),
judged AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM counts)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND n_words - n_line_words >= 20 AND n_words - n_line_words >= CAST(0.3 AS DOUBLE) * n_words AS kept,
       n_frequent_lines, n_line_words
FROM judged"""


LEAF = ", ".join(f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || {c}, '-')" for c in ("doc_id", "source", "lang", "n_chars", "text"))


def _climb(name: str, levels: int) -> list[str]:
    """The levels of a tree over ``{name}0 (grp, idx, n, h)`` and the rows of ``{name}p0 (r, idx,
    n, proof, fold)`` on their way up, one level at a time."""
    out = []
    for k in range(levels):
        out.append(
            f"{name}{k + 1} AS MATERIALIZED (SELECT grp, idx // 2 AS idx, (any_value(n) + 1) // 2 AS n, "
            f"CASE WHEN any_value(n) > 1 THEN sha256(string_agg(h, '' ORDER BY idx)) ELSE any_value(h) END AS h "
            f"FROM {name}{k} GROUP BY grp, idx // 2)"
        )
        out.append(
            f"{name}p{k + 1} AS MATERIALIZED (SELECT p.r, p.grp, p.idx // 2 AS idx, (p.n + 1) // 2 AS n, p.proof || coalesce(s.h, '') AS proof, "
            f"CASE WHEN p.n = 1 THEN p.fold WHEN p.idx % 2 = 1 THEN sha256(s.h || p.fold) ELSE sha256(p.fold || coalesce(s.h, '')) END AS fold "
            f"FROM {name}p{k} p LEFT JOIN {name}{k} s ON s.grp IS NOT DISTINCT FROM p.grp AND s.idx = xor(p.idx, 1))"
        )
    return out


def merkle_sql(levels: int = 24, groups: int = 8) -> str:
    """Trees of at most 2**levels leaves a group and 2**groups groups, level by level."""
    return ",\n".join(
        [
            """WITH RECURSIVE steps(i, k, c) AS (
  SELECT i, 0, i FROM range(256) t(i)
  UNION ALL SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM steps WHERE k < 8
)""",
            "crc AS (SELECT list(c ORDER BY i) AS tab FROM steps WHERE k = 8)",
            f"""leaves AS MATERIALIZED (
  SELECT d.*, sha256(concat({LEAF})) AS leaf,
         CASE WHEN xor(list_reduce([4294967295] || list_transform(range(1, length(CAST(doc_id AS VARCHAR)) + 1), lambda i: CAST(ascii(substr(CAST(doc_id AS VARCHAR), i, 1)) AS BIGINT)),
                lambda a, b: xor(tab[(xor(a, b) & 255) + 1], a >> 8)), 4294967295) % 7 = 0
              THEN sha256(concat({LEAF.replace('n_chars', '(n_chars + 1)')})) END AS bad
  FROM documents d, crc
)""",
            """placed AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, lang AS grp, leaf, coalesce(bad, leaf) AS first,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, bad NULLS FIRST) - 1 AS idx, count(*) OVER (PARTITION BY lang) AS n
  FROM leaves
)""",
            "a0 AS MATERIALIZED (SELECT grp, idx, n, leaf AS h FROM placed)",
            "ap0 AS MATERIALIZED (SELECT r, grp, idx, n, '' AS proof, first AS fold FROM placed)",
            *_climb("a", levels),
            f"subs AS MATERIALIZED (SELECT grp, h, row_number() OVER (ORDER BY grp NULLS FIRST) - 1 AS idx, count(*) OVER () AS n FROM a{levels})",
            "b0 AS MATERIALIZED (SELECT 0 AS grp, idx, n, h FROM subs)",
            f"bp0 AS MATERIALIZED (SELECT p.r, 0 AS grp, s.idx, s.n, p.proof, p.fold FROM ap{levels} p JOIN subs s ON s.grp IS NOT DISTINCT FROM p.grp)",
            *_climb("b", groups),
        ]
    ) + f"""
SELECT p.doc_id, p.leaf, s.h AS subroot, t.h AS root, sha256(f.proof) AS proof_sha256, f.fold AS folded_root, f.fold = t.h AS verified
FROM placed p JOIN bp{groups} f ON f.r = p.r JOIN subs s ON s.grp IS NOT DISTINCT FROM p.grp CROSS JOIN b{groups} t"""


def clusters_sql(k: int = 8, rounds: int = 10, dims: int = 64, scale: int = 1024, seed: int = 3) -> str:
    """The rounds of exact k-means, one CTE each."""
    def assigned(i):
        return (
            f"a{i} AS MATERIALIZED (SELECT r, c, dist FROM (SELECT r, c, dist, row_number() OVER (PARTITION BY r ORDER BY dist, c) AS nr FROM "
            f"(SELECT v.r, k.c, sum(CAST(v.x - k.x AS HUGEINT) * (v.x - k.x)) AS dist FROM vals v JOIN c{i} k ON k.d = v.d GROUP BY v.r, k.c)) WHERE nr = 1)"
        )

    parts = [
        f"""kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dims}
)""",
        "vals AS MATERIALIZED (SELECT r, unnest(range(len(v))) AS d, unnest(v) AS x FROM kept)",
        f"""start AS MATERIALIZED (
  SELECT r, row_number() OVER (ORDER BY sha256('{seed}:' || coalesce(CAST(vec_id AS VARCHAR), '')), v) - 1 AS c FROM kept QUALIFY c < {k}
)""",
        "c0 AS MATERIALIZED (SELECT s.c, v.d, v.x FROM start s JOIN vals v ON v.r = s.r)",
    ]
    for i in range(rounds):
        parts += [
            assigned(i),
            f"m{i} AS MATERIALIZED (SELECT a.c, v.d, sum(v.x) AS s, count(*) AS n FROM a{i} a JOIN vals v ON v.r = a.r GROUP BY a.c, v.d)",
            f"c{i + 1} AS MATERIALIZED (SELECT k.c, k.d, CAST(CASE WHEN m.n IS NULL THEN k.x WHEN m.s >= 0 THEN m.s // m.n ELSE -((-m.s + m.n - 1) // m.n) END AS BIGINT) AS x "
            f"FROM c{i} k LEFT JOIN m{i} m ON m.c = k.c AND m.d = k.d)",
        ]
    parts += [
        assigned(rounds),
        f"names AS (SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY d)) AS h FROM c{rounds} GROUP BY c)",
    ]
    return "WITH " + ",\n".join(parts) + f"""
SELECT k.vec_id, CAST(a.c AS INTEGER) AS cluster, CAST(a.dist AS BIGINT) AS distance,
       CAST(sum(a.dist) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia, CAST(sum(a.dist) OVER () AS BIGINT) AS inertia, h.h AS centroid_sha256
FROM a{rounds} a JOIN kept k ON k.r = a.r JOIN names h ON h.c = a.c"""


ORACLE_SQL: dict[str, str] = {
    "op2_quality_rules": QUALITY_RULES,
    "op12_merkle_manifest": merkle_sql(),
    "op13_centroid_clustering": clusters_sql(),
}
