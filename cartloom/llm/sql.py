"""SQL counterparts of the operators that SQL can express, for another engine on the same tables."""

from __future__ import annotations

_BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((part[{part}] >> {shift}) & 31), 1)"
    for part in range(1, 5)
    for shift in range(35, -1, -5)
)

_WARC = f"""
WITH payload AS (
    SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages
),
digest AS (
    SELECT page_id, payload_bytes, min(page_id) OVER (PARTITION BY hex) AS original,
           [('0x' || substr(hex, k, 10))::BIGINT FOR k IN [1, 11, 21, 31]] AS part
    FROM payload
)
SELECT page_id, payload_bytes, {_BASE32} AS payload_digest,
       CASE WHEN page_id = original THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> original THEN original END AS refers_to
FROM digest"""


def _strength(units: str) -> str:
    """Prior strength of a level whose units have n, bad and the mean above."""
    return f"""(SELECT (1 - rho) / rho FROM (
        SELECT greatest(0.002e0, least(0.9e0, coalesce(
            CASE WHEN count(*) > 1 THEN
                (sum(n * (bad / n - above) ** 2 / greatest(above * (1 - above), 1e-6)) - (count(*) - 1))
                / (sum(n) - sum(n * n) / sum(n) - (count(*) - 1)) END, 0.05e0))) AS rho
        FROM {units} WHERE n > 0))"""


def _mean(units: str) -> str:
    return f"({_strength(units)} * above + bad) / ({_strength(units)} + n)"


_REPUTATION = f"""
WITH parted AS (
    SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
    FROM pages
),
page AS (
    SELECT page_id, translate(regexp_extract(coalesce(rest, ''), '^([^/?#]*)', 1),
                              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path
    FROM parted
),
outcome AS (
    SELECT doc_id AS page_id, count(*) AS n, sum(CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END) AS bad
    FROM labels WHERE (quality = 0 OR toxic = 1) IS NOT NULL GROUP BY doc_id
),
hosts AS (
    SELECT host, coalesce(sum(n), 0)::DOUBLE AS n, coalesce(sum(bad), 0)::DOUBLE AS bad,
           string_split(regexp_replace(host, ':[0-9]*$', ''), '.') AS names
    FROM page LEFT JOIN outcome USING (page_id) GROUP BY host
),
leveled AS (
    SELECT host, n, bad, names[-1] AS suffix, array_to_string(names[-2:], '.') AS domain FROM hosts
),
suffixes AS (
    SELECT suffix, sum(n) AS n, sum(bad) AS bad,
           (sum(sum(bad)) OVER () + 1) / (sum(sum(n)) OVER () + 2) AS above
    FROM leveled GROUP BY suffix
),
domains AS (
    SELECT l.domain, sum(l.n) AS n, sum(l.bad) AS bad, any_value(u.above) AS above
    FROM leveled l JOIN (SELECT suffix, {_mean("suffixes")} AS above FROM suffixes) u USING (suffix)
    GROUP BY l.domain
),
units AS (
    SELECT l.host, l.n, l.bad, d.above
    FROM leveled l JOIN (SELECT domain, {_mean("domains")} AS above FROM domains) d USING (domain)
),
posterior AS (
    SELECT host, a / (a + b) AS share,
           greatest(0, a / (a + b) - 1.64e0 * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))) AS bound
    FROM (SELECT host, s * above + bad AS a, s * (1 - above) + n - bad AS b
          FROM units, (SELECT {_strength("units")} AS s))
),
ruled AS (
    SELECT *, CASE
        WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND path LIKE '/en/%' THEN 'www.example.com/en/'
        WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/en/%' THEN 'example.com/en/'
        WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/es/%' THEN 'net/es/'
        WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/fr/%' THEN 'net/fr/'
        WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/%' THEN 'com/' END AS rule
    FROM page JOIN posterior USING (host)
)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN bound > 0.35e0 THEN 'block' ELSE 'allow' END AS verdict,
       round(share, 6) AS share, round(bound, 6) AS bound
FROM ruled"""

_MIX = r"""
WITH sized AS (
    SELECT doc_id, source, md5(concat_ws(':', CAST(doc_id AS VARCHAR), '7')) AS key,
           CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
    FROM documents
),
weighed AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size, 2e0 * sum(size) AS cap,
           [3e0, 1e0, 2e0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight
    FROM sized GROUP BY source
),
filled AS (
    SELECT *, (sum(source_size) OVER () * 1.5e0 - coalesce(sum(cap) OVER before, 0))
              / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS even
    FROM weighed
    WINDOW before AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
target AS (
    SELECT source, source_size, least(cap, weight * coalesce(
        (SELECT even FROM filled WHERE cap / weight >= even ORDER BY cap / weight, source NULLS LAST LIMIT 1),
        'inf'::DOUBLE)) AS target
    FROM filled
),
placed AS (
    SELECT doc_id, size, source_size, target, CAST(round(target) AS BIGINT) AS budget,
           sum(size) OVER (PARTITION BY s.source ORDER BY key ROWS UNBOUNDED PRECEDING) - size AS earlier
    FROM sized s JOIN target t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       CASE WHEN source_size = 0 THEN 0 ELSE CAST((budget // source_size) * size
           + greatest(0, least(size, budget % source_size - earlier)) AS BIGINT) END AS taken
FROM placed"""

# --- Merkle manifest

_CRC = """crc AS (
    SELECT list(list_reduce([k, 0, 0, 0, 0, 0, 0, 0, 0],
                            lambda c, _ : CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)
                ORDER BY k) AS steps
    FROM (SELECT unnest(range(256)) AS k)
)"""


def _crc32(value: str) -> str:
    """CRC-32 of a short ASCII string; needs the relation ``crc``."""
    codes = f"list_transform(string_split({value}, ''), lambda letter : ascii(letter)::BIGINT)"
    step = "xor(crc.steps[1 + (xor(c, b) & 255)], c >> 8)"
    return f"xor(list_reduce(list_concat([4294967295], {codes}), lambda c, b : {step}), 4294967295)"


def _leaf(text: str) -> str:
    fields = ("doc_id", "source", "lang", "n_chars")
    parts = [f"coalesce(strlen({f}::VARCHAR) || ':' || {f}, '-')" for f in fields]
    return f"sha256({' || '.join(parts)} || coalesce(strlen({text}) || ':' || {text}, '-'))"


#: Heights that the SQL goes through: 16 ** 5 documents of a source, and as many sources.
_HEIGHTS = 5


def _forest(name: str, group: str) -> str:
    """Relations of the runs (children, digest) at all heights over ``name``_0 (group, rank, total, digest)."""
    keys = f"{group}, " if group else ""
    return "".join(
        f""",
{name}_run_{k} AS (
    SELECT {keys}rank // 16 AS rank, (total + 15) // 16 AS total,
           string_agg(digest, '' ORDER BY rank) AS children, total > 1 AS joined
    FROM {name}_{k} GROUP BY {keys}rank // 16, total
),
{name}_{k + 1} AS (
    SELECT {keys}rank, total, CASE WHEN joined THEN sha256(children) ELSE children END AS digest FROM {name}_run_{k}
)"""
        for k in range(_HEIGHTS)
    )


def _merkle() -> str:
    path, joins = [], ""
    for name, rank, group in (("tree", "doc.rank", " AND {}.source IS NOT DISTINCT FROM doc.source"), ("top", "place", "")):
        for k in range(_HEIGHTS):
            run, at = f"{name}_run_{k}", f"(64 * (({rank} // {16**k}) % 16))::INT"
            path.append(
                f"{{'before': CASE WHEN {run}.joined THEN left({run}.children, {at}) ELSE '' END, "
                f"'after': CASE WHEN {run}.joined THEN substr({run}.children, {at} + 65) ELSE '' END, "
                f"'joined': {run}.joined}}"
            )
            joins += f" JOIN {run} ON {run}.rank = {rank} // {16 ** (k + 1)}{group.format(run)}"
    proof = "list_transform(path, lambda step : step.before || step.after)"
    start = "{'before': coalesce(altered, leaf), 'after': '', 'joined': false}"
    step = "{'before': sha256(s.before || n.before || s.after), 'after': '', 'joined': false}"
    fold = f"list_reduce(list_concat([{start}], path), lambda n, s : CASE WHEN s.joined THEN {step} ELSE n END).before"
    return f"""
WITH {_CRC},
doc AS (
    SELECT doc_id, source, leaf, altered, count(*) OVER (PARTITION BY source) AS total,
           row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank
    FROM (
        SELECT doc_id, source, {_leaf("text")} AS leaf,
               CASE WHEN doc_id IS NOT NULL AND {_crc32("doc_id::VARCHAR")} % 5 = 0
                    THEN {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}
               END AS altered
        FROM documents, crc
    )
),
tree_0 AS (SELECT source, rank, total, leaf AS digest FROM doc){_forest("tree", "source")},
subroots AS (
    SELECT source, digest AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place,
           count(*) OVER () AS total
    FROM tree_{_HEIGHTS}
),
top_0 AS (SELECT place AS rank, total, subroot AS digest FROM subroots){_forest("top", "")},
asked AS (
    SELECT doc_id, leaf, altered, subroot, (SELECT digest FROM top_{_HEIGHTS}) AS root, [{", ".join(path)}] AS path
    FROM doc JOIN subroots ON subroots.source IS NOT DISTINCT FROM doc.source{joins}
),
found AS (
    SELECT doc_id, leaf, subroot, root, sha256(array_to_string({proof}, '')) AS proof_sha256, {fold} AS folded_root
    FROM asked
)
SELECT *, folded_root = root AS verified FROM found"""


_TRIE = f"""
WITH {_CRC},
turn_of AS (
    SELECT conv_id, turn, strlen(coalesce(text, '')) AS bytes,
           sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS id
    FROM conversations WHERE conv_id IS NOT NULL
),
listed AS (
    SELECT conv_id, list({{'id': id, 'bytes': bytes}} ORDER BY turn NULLS FIRST, id) AS turns
    FROM turn_of GROUP BY conv_id
),
started AS (SELECT conv_id, turns, {_crc32("conv_id::VARCHAR")} % 9 AS h FROM listed, crc),
rebuilt AS (
    SELECT own.conv_id, list_concat(coalesce(base.turns[1:own.h], []), own.turns[own.h + 1:]) AS turns
    FROM started own LEFT JOIN listed base ON base.conv_id = own.conv_id - own.conv_id % 5
),
path AS (
    SELECT conv_id, depth, len(turns) = depth AS ends, coalesce(turns[depth].bytes, 0) AS bytes,
           array_to_string(list_transform(turns[1:depth], lambda turn : turn.id), '') AS key
    FROM (SELECT conv_id, turns, unnest(range(len(turns) + 1)) AS depth FROM rebuilt)
),
node AS (
    SELECT key, depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(bytes) AS bytes, count(*) FILTER (ends) AS n_ends,
           sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
    FROM path GROUP BY key, depth
),
below AS (
    SELECT up.key, up.depth, sum((down.n_convs - 1) * down.bytes)::BIGINT AS saved_tokens,
           count(*) FILTER (down.n_convs = down.n_ends) AS n_leaves,
           count(*) FILTER (down.depth = up.depth + 1) AS n_children
    FROM (SELECT key, unnest(range(depth + 1)) AS high, depth, n_convs, bytes, n_ends FROM node) down
    JOIN node up ON up.depth = down.high AND up.key = left(down.key, (64 * down.high)::INT)
    GROUP BY up.key, up.depth
)
SELECT node.conv_id, node.depth, parent.conv_id AS parent_conv_id, node.n_convs, n_children, n_leaves, saved_tokens,
       node.ends_sha256
FROM node JOIN below USING (key, depth)
LEFT JOIN node parent ON parent.depth = node.depth - 1 AND parent.key = left(node.key, (64 * parent.depth)::INT)"""

# Vectors with a direction, all pairs of them: small tables only.
_CAPS = """
WITH RECURSIVE vector AS (
    SELECT vec_id, row_number() OVER () AS row, embedding::DOUBLE[] AS v FROM embeddings
),
pair AS (
    SELECT a.row AS a, b.row AS b
    FROM vector a JOIN vector b ON a.row <> b.row AND len(a.v) = len(b.v)
    WHERE list_dot_product(a.v, b.v) >= 0.95 * sqrt(list_dot_product(a.v, a.v) * list_dot_product(b.v, b.v))
      AND list_dot_product(a.v, a.v) > 0 AND list_dot_product(b.v, b.v) > 0
),
reach AS (
    SELECT row AS a, row AS b FROM vector
    UNION SELECT reach.a, pair.b FROM reach JOIN pair ON pair.a = reach.b
),
named AS (
    SELECT reach.a AS row, min(vector.vec_id) AS component_id
    FROM reach JOIN vector ON vector.row = reach.b GROUP BY reach.a
)
SELECT vec_id, (SELECT count(*) FROM pair WHERE a = row) AS n_links, component_id,
       vec_id IS NOT DISTINCT FROM component_id AS kept
FROM vector JOIN named USING (row)"""


ORACLE: dict[str, str] = {
    "op2_warc_revisits": _WARC,
    "op5_host_reputation": _REPUTATION,
    "op7_source_mix": _MIX,
    "op11_cap_filters": _CAPS,
    "op12_merkle_descent": _merkle(),
    "op13_prefix_trie": _TRIE,
}
