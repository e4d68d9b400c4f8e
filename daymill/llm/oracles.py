"""DuckDB SQL of the operators whose rounds SQL can spell out one after the other."""

from __future__ import annotations

FINITE = "len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"
SQUARED = "list_sum(list_transform(list_zip(x.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"


def _rounds(rounds: int, start: str, extra: str, key: str) -> str:
    """CTEs c0, a0, c1, a1, ...: points by ``key`` and i, and the nearest of them of every x."""
    ctes = [f"c0 AS MATERIALIZED ({start})"]
    for r in range(rounds + 1):
        ctes.append(f"""a{r} AS MATERIALIZED (
    SELECT * EXCLUDE (nth) FROM (SELECT x.*, c.i, {SQUARED} AS d, row_number() OVER (PARTITION BY x.id{extra} ORDER BY {SQUARED}, c.i) AS nth
    FROM x JOIN c{r} AS c ON {key}) WHERE nth = 1)""")
        if r < rounds:
            group = f"i{extra.replace('x.', '')}"
            ctes.append(f"""m{r} AS MATERIALIZED (
    SELECT {group}, list(m ORDER BY nr) AS v FROM (
        SELECT {group}, nr, floor(sum(v[nr]) / count(*))::BIGINT AS m FROM a{r}, (SELECT unnest(range(1, (SELECT max(len(v)) + 1 FROM x))) AS nr) GROUP BY {group}, nr)
    GROUP BY {group}),
c{r + 1} AS MATERIALIZED (SELECT c.* REPLACE (coalesce(m.v, c.v) AS v) FROM c{r} AS c LEFT JOIN m{r} AS m ON {" AND ".join(f"c.{g.strip()} = m.{g.strip()}" for g in group.split(","))})""")
    return ",\n".join(ctes)


CLUSTERS = f"""
WITH x AS MATERIALIZED (
    SELECT row_number() OVER () AS id, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v
    FROM embeddings WHERE len(embedding) = 64 AND {FINITE}
),
{_rounds(3, "SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS i, v FROM x ORDER BY sha256('1:' || vec_id) LIMIT 16", "", "true")}
SELECT vec_id, a.i::INTEGER AS cluster, d::BIGINT AS distance, (sum(d) OVER (PARTITION BY a.i))::BIGINT AS cluster_inertia,
       (sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string(c3.v, ',')) AS centroid_sha256
FROM a3 AS a JOIN c3 ON a.i = c3.i"""

CODES = f"""
WITH whole AS MATERIALIZED (
    SELECT row_number() OVER () AS id, vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS w
    FROM embeddings WHERE embedding IS NOT NULL AND {FINITE}
), x AS MATERIALIZED (
    SELECT id, vec_id, label, p, w[p * (len(w) // 4) + 1 : (p + 1) * (len(w) // 4)] AS v FROM whole, (SELECT unnest(range(4)) AS p)
),
{_rounds(4, "SELECT row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS i, p, v FROM x QUALIFY i < 256", ", x.p", "x.p = c.p")},
coded AS (
    SELECT id, vec_id, label, string_agg(lpad(lower(to_hex(i)), 2, '0'), '' ORDER BY p) AS code, sum(d)::BIGINT AS error
    FROM a4 GROUP BY id, vec_id, label
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
       (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, i)) FROM c4) AS codebooks_sha256
FROM coded"""

MIXED = r"""
WITH sized AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents
), sources AS (
    SELECT source, sum(size)::HUGEINT AS source_size, ([5, 2, 1])[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w
    FROM sized GROUP BY source
), filled AS (
    SELECT *, 3 * source_size AS bound, sum(source_size) OVER () AS total,
           coalesce(sum(3 * source_size) OVER before, 0) AS given, sum(w) OVER () - coalesce(sum(w) OVER before, 0) AS open
    FROM sources WINDOW before AS (ORDER BY source_size::DOUBLE / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), judged AS (
    SELECT *, bound * open < (total - given) * w AS above FROM filled
), aimed AS (
    SELECT source, source_size::BIGINT AS source_size,
           CASE WHEN above THEN bound::DOUBLE
                ELSE (total - coalesce(sum(bound) FILTER (above) OVER (), 0))::DOUBLE * w / (sum(w) FILTER (NOT above) OVER ())::DOUBLE END AS target,
           ('0x' || substr(sha256('mix:' || coalesce(source, '')), 1, 8))::BIGINT::DOUBLE / 4294967296::DOUBLE AS u
    FROM judged
), placed AS (
    SELECT doc_id, size, source_size, target, u, CASE WHEN source_size > 0 THEN target / source_size::DOUBLE ELSE 0 END AS rate,
           row_number() OVER (PARTITION BY sized.source ORDER BY size, doc_id NULLS FIRST) AS place
    FROM sized JOIN aimed ON sized.source IS NOT DISTINCT FROM aimed.source
)
SELECT doc_id, size, source_size, target, size * (floor(place * rate + u) - floor((place - 1) * rate + u))::BIGINT AS taken FROM placed"""


#: Conversations rendered and read as the digest of ``chat`` describes them.
CHATS = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), rendered AS (
    SELECT *, length('<|turn|>' || replace(replace(role, '\', '\\'), '<|', '<\|') || '<|text|>'
        || replace(replace(text, '\', '\\'), '<|', '<\|') || '<|end|>') AS chars FROM turns
), placed AS (
    SELECT *, role = 'assistant' AS reply, row_number() OVER w AS place,
           sum(chars) OVER (w ROWS UNBOUNDED PRECEDING) AS so_far
    FROM rendered WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (reply), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (reply), '')) AS loss_sha256,
       (coalesce(sum(so_far) FILTER (reply), 0) + max(so_far) - coalesce(max(so_far) FILTER (reply), 0))::BIGINT AS formatted_chars
FROM placed GROUP BY conv_id"""

#: Every window of 200 bytes by its digest; runs of bytes that windows found twice cover.
REPEATS = """
WITH bytes AS (
    SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), pieces AS (
    SELECT doc_id, c, substr(h, 2 * c + 1, 998) AS p
    FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 199, 300)) AS c FROM bytes)
), windows AS (
    SELECT doc_id, c + i AS s, md5(substr(p, 2 * i + 1, 400)) AS w
    FROM (SELECT doc_id, c, p, unnest(range(least(300, length(p) // 2 - 199))) AS i FROM pieces)
), hits AS (
    SELECT doc_id, s, s > lag(s) OVER (PARTITION BY doc_id ORDER BY s) + 200 AS apart
    FROM windows SEMI JOIN (SELECT w FROM windows GROUP BY w HAVING count(*) > 1) USING (w)
), numbered AS (
    SELECT doc_id, s, sum(coalesce(apart, true)::INT) OVER (PARTITION BY doc_id ORDER BY s) AS run FROM hits
), runs AS (
    SELECT doc_id, min(s) AS low, max(s) + 200 AS high FROM numbered GROUP BY doc_id, run
), parts AS (
    SELECT doc_id, low, high, coalesce(lag(high) OVER (PARTITION BY doc_id ORDER BY low), 0) AS since FROM runs
), cut AS (
    SELECT doc_id, count(*) AS n_spans, sum(high - low) AS n_removed, max(high) AS last,
           string_agg(substr(h, 2 * since + 1, 2 * (low - since)), '' ORDER BY low) AS before
    FROM parts JOIN bytes USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, length(h) // 2 AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(before, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM bytes LEFT JOIN cut USING (doc_id)"""
