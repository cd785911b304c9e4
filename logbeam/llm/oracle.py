"""DuckDB SQL for the training-data queries that SQL can express.

Written independently of the Spark code: constants are spelled out.  The other
queries (1, 2, 3, 4, 8, 9, 10, 13 and the pipeline) are tested against brute force
or an independent library in ``tests/llm``.
"""

from __future__ import annotations


def _seeded(seed: int, *parts: str) -> str:
    text = " || '|' || ".join([f"'{seed}'", *(f"coalesce(CAST({p} AS VARCHAR), '~')" for p in parts)])
    return f"CAST('0x' || substr(md5({text}), 1, 15) AS BIGINT)"


def _apportioned(name: str, votes: str, group: str, party: str) -> str:
    """CTEs that give ``votes`` (group, party, vote, seats, most) a quota by
    highest quotients, all quotients of every party ranked."""
    over = f"PARTITION BY {group} " if group else ""
    keys = f"{group}, {party}" if group else party
    return f"""
{name}_quotients AS (
  SELECT v.*, k, row_number() OVER ({over}ORDER BY vote / (2 * k + 1) DESC, {party} IS NULL, {party}, k) AS r
  FROM (SELECT *, unnest(range(CAST(most AS BIGINT))) AS k FROM {votes} WHERE vote > 0) v),
{name}_won AS (SELECT {keys}, count(*) AS won FROM {name}_quotients WHERE r <= seats GROUP BY ALL),
{name} AS (
  SELECT v.*, coalesce(w.won, 0) AS quota FROM {votes} v LEFT JOIN {name}_won w
  ON {' AND '.join(f'v.{k} IS NOT DISTINCT FROM w.{k}' for k in keys.split(', '))})"""


MIX = f"""
WITH sizes AS (
  SELECT doc_id, source,
    CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size FROM documents),
per_source AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sizes GROUP BY source),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY source IS NULL, source) - 1 AS rank, sum(source_size) OVER () AS total FROM per_source),
weighted AS (SELECT *, rank % 3 + 1 AS weight, 3 * source_size AS cap FROM ranked),
running AS (
  SELECT *, total - coalesce(sum(cap) OVER w, 0) AS still, sum(weight) OVER () - coalesce(sum(weight) OVER w, 0) AS weight_left
  FROM weighted WINDOW w AS (ORDER BY CAST(cap AS DOUBLE) / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
levels AS (SELECT *, CAST(still AS DOUBLE) / weight_left AS level, CAST(cap AS DOUBLE) / weight AS ratio FROM running),
aimed AS (
  SELECT source, source_size, CAST(total AS BIGINT) AS total, greatest(CAST(ceil(source_size / 1048576.0) AS BIGINT), 1) AS shards,
    CASE WHEN ratio <= level THEN CAST(cap AS DOUBLE) ELSE max(level) FILTER (WHERE ratio > level) OVER () * weight END AS target
  FROM levels),
spread AS (
  SELECT s.*, a.source_size, a.total, a.target, {_seeded(11, 's.doc_id')} % a.shards AS shard, {_seeded(12, 's.doc_id', 's.size')} AS place
  FROM sizes s JOIN aimed a ON s.source IS NOT DISTINCT FROM a.source),
placed AS (
  SELECT *, CAST(coalesce(sum(size) OVER (
    PARTITION BY source, shard ORDER BY place, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS first
  FROM spread),
shard_sizes AS (
  SELECT source, shard, CAST(sum(size) AS BIGINT) AS shard_size, any_value(target) AS target, any_value(total) AS total,
    CAST(ceil(sum(size) / 16.0) AS BIGINT) AS blocks FROM spread GROUP BY source, shard),
source_votes AS (
  SELECT source, any_value(target) AS vote, CAST(round(any_value(total) / 16.0) AS BIGINT) AS seats, sum(blocks) * 3 AS most
  FROM shard_sizes GROUP BY source),
{_apportioned('source_quota', 'source_votes', '', 'source')},
shard_votes AS (
  SELECT s.source, s.shard, s.blocks, CAST(s.shard_size AS DOUBLE) AS vote, q.quota AS seats, s.blocks * 3 AS most
  FROM shard_sizes s JOIN source_quota q ON s.source IS NOT DISTINCT FROM q.source),
{_apportioned('shard_quota', 'shard_votes', 'source', 'shard')},
cut AS (
  SELECT p.*, greatest(q.blocks, 1) AS blocks, q.quota // greatest(q.blocks, 1) AS every, q.quota % greatest(q.blocks, 1) AS rest,
    {_seeded(13, 'p.source', 'p.shard')} % greatest(q.blocks, 1) AS turn
  FROM placed p JOIN shard_quota q ON p.source IS NOT DISTINCT FROM q.source AND p.shard = q.shard),
pieces AS (
  SELECT *, unnest(CASE WHEN size > 0 THEN range(first // 16, (first + size - 1) // 16 + 1) ELSE [] END) AS j FROM cut),
copied AS (
  SELECT *, least((j + 1) * 16, first + size) - greatest(j * 16, first) AS words,
    every + (((j + turn) % blocks + 1) * rest) // blocks - (((j + turn) % blocks) * rest) // blocks AS copies FROM pieces),
taken AS (
  SELECT doc_id, source, size, first, CAST(sum(words * copies) AS BIGINT) AS taken, CAST(count(*) FILTER (WHERE copies > 0) AS INTEGER) AS n_blocks
  FROM copied GROUP BY doc_id, source, size, first)
SELECT p.doc_id, p.size, p.source_size, p.target, coalesce(t.taken, 0) AS taken, p.source, coalesce(t.n_blocks, 0) AS n_blocks
FROM placed p LEFT JOIN taken t ON p.doc_id IS NOT DISTINCT FROM t.doc_id AND p.source IS NOT DISTINCT FROM t.source
  AND p.size = t.size AND p.first = t.first
"""

LINES = r"""
WITH split AS (
  SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS pos
  FROM documents),
lines AS (
  SELECT doc_id, pos, line, list_filter(regexp_split_to_array(line, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words FROM split),
real AS (SELECT *, len(words) AS n, doc_id * 1000000000 + pos AS spot FROM lines WHERE len(words) > 0),
firsts AS (SELECT words, any_value(n) AS n, min(spot) AS spot FROM real GROUP BY words),
gaps AS (SELECT words, n, spot, unnest(range(1, n + 1)) AS i FROM firsts WHERE n >= 10),
shorter AS (
  SELECT *, list_concat(list_slice(words, 1, i - 1), list_slice(words, i + 1, n)) AS rest FROM gaps),
by_gap AS (SELECT i, rest, min(spot) AS early FROM shorter GROUP BY i, rest),
by_rest AS (SELECT rest, min(spot) AS early FROM shorter GROUP BY rest),
near AS (
  SELECT s.words FROM shorter s JOIN by_gap g ON s.i = g.i AND s.rest = g.rest WHERE g.early < s.spot
  UNION SELECT s.words FROM shorter s JOIN firsts f ON s.rest = f.words WHERE f.n >= 10 AND f.spot < s.spot
  UNION SELECT f.words FROM firsts f JOIN by_rest r ON f.words = r.rest WHERE f.n >= 10 AND r.early < f.spot),
gone AS (
  SELECT r.doc_id, r.pos FROM real r JOIN firsts f ON r.words = f.words WHERE r.spot > f.spot
  UNION SELECT r.doc_id, r.pos FROM real r JOIN near x ON r.words = x.words),
kept AS (
  SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.pos) FILTER (WHERE g.pos IS NULL) AS text,
    count(*) AS n_lines, count(g.pos) AS n_removed
  FROM lines l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.pos = g.pos GROUP BY l.doc_id)
SELECT d.doc_id, CAST(coalesce(k.n_lines, 0) AS INTEGER) AS n_lines, CAST(coalesce(k.n_removed, 0) AS INTEGER) AS n_removed,
  sha256(coalesce(k.text, '')) AS kept_sha256
FROM documents d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""

REPEATS = """
WITH raw AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
bytes AS (SELECT doc_id, h, len(h) // 2 AS n FROM raw),
windows AS (
  SELECT doc_id, p, substr(h, 2 * p + 1, 100) AS w FROM (SELECT doc_id, h, unnest(range(n - 49)) AS p FROM bytes WHERE n >= 50)),
firsts AS (SELECT w, min(doc_id) AS first FROM windows GROUP BY w HAVING min(doc_id) < max(doc_id)),
gone AS (SELECT s.doc_id, s.p FROM windows s JOIN firsts f ON s.w = f.w WHERE f.first < s.doc_id),
starts AS (
  SELECT doc_id, p, CASE WHEN p <= lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 50 THEN 0 ELSE 1 END AS new FROM gone),
numbered AS (SELECT doc_id, p, sum(new) OVER (PARTITION BY doc_id ORDER BY p ROWS UNBOUNDED PRECEDING) AS run FROM starts),
spans AS (SELECT doc_id, run, min(p) AS lo, max(p) + 50 AS hi FROM numbered GROUP BY doc_id, run),
pieces AS (
  SELECT s.doc_id, s.lo, s.hi, coalesce(lag(s.hi) OVER (PARTITION BY s.doc_id ORDER BY s.lo), 0) AS before,
    lead(s.lo) OVER (PARTITION BY s.doc_id ORDER BY s.lo) IS NULL AS last FROM spans s),
kept AS (
  SELECT b.doc_id, CAST(sum(hi - lo) AS BIGINT) AS n_removed, count(*) AS n_spans,
    string_agg(substr(h, 2 * before + 1, 2 * (lo - before)) || CASE WHEN last THEN substr(h, 2 * hi + 1) ELSE '' END, '' ORDER BY lo) AS h
  FROM pieces p JOIN bytes b ON p.doc_id = b.doc_id GROUP BY b.doc_id)
SELECT b.doc_id, b.n AS n_bytes, coalesce(k.n_removed, 0) AS n_removed, coalesce(k.n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(k.h, b.h))) AS kept_sha256
FROM bytes b LEFT JOIN kept k ON b.doc_id = k.doc_id
"""


CHAT = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
written AS (
  SELECT *, regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g') AS t,
    regexp_replace(replace(regexp_replace(role, '<(\\*)n>', '<\1\\n>', 'g'), chr(10), '<n>'), '<(\\*)\|', '<\1\\|', 'g') AS r FROM turns)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length('<|im_start|>') + length(r) + 1 + length(t) + length('<|im_end|>') + 1) AS BIGINT) AS formatted_chars
FROM written GROUP BY conv_id
"""


def _merkle(levels: int = 6, source_levels: int = 3) -> str:
    """Levels are written out one by one: 16^6 documents a source, 16^3 sources."""

    def leaf(text: str) -> str:
        values = [f"CAST({c} AS VARCHAR)" for c in ("doc_id", "source", "lang", "n_chars")] + [text]
        return "sha256(" + " || ".join(f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in values) + ")"

    def up(name: str, below: str) -> str:
        return (
            f"{name} AS (SELECT g, idx // 16 AS idx, (n + 15) // 16 AS n, n = 1 AS lone, list(h ORDER BY idx) AS kids, "
            f"CASE WHEN n = 1 THEN any_value(h) ELSE sha256(string_agg(h, '' ORDER BY idx)) END AS h FROM {below} GROUP BY g, idx // 16, n)")

    bits = "flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: [ord(c), 0, 0, 0, 0, 0, 0, 0]))"
    step = "xor(xor(c, x) >> 1, 3988292384 * (xor(c, x) & 1))"
    crc = f"xor(list_reduce(list_concat([4294967295], {bits}), lambda c, x: {step}), 4294967295)"
    low = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    ctes = [
        f"base AS (SELECT doc_id, source AS g, {leaf('text')} AS leaf, CASE WHEN {crc} % 5 = 0 THEN {leaf(low)} ELSE {leaf('text')} END AS tried FROM documents)",
        "l0 AS (SELECT *, leaf AS h, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY g) AS n FROM base)",
        *(up(f"l{i + 1}", f"l{i}") for i in range(levels)),
        f"s0 AS (SELECT 0 AS g, g AS source, h, row_number() OVER (ORDER BY g NULLS FIRST) - 1 AS idx, count(*) OVER () AS n FROM l{levels})",
        *(up(f"s{i + 1}", f"s{i}") for i in range(source_levels)),
        f"f0 AS (SELECT l.doc_id, l.leaf, l.g, l.idx, l.tried AS node, '' AS beside, s.h AS subroot, s.idx AS place, r.h AS root "
        f"FROM l0 l JOIN s0 s ON l.g IS NOT DISTINCT FROM s.source, s{source_levels} r)",
    ]
    for i in range(levels + source_levels):
        inner = i < levels
        table, width, at = (f"l{i + 1}", 16**i, "f.idx") if inner else (f"s{i + 1 - levels}", 16 ** (i - levels), "f.place")
        own = f"({at} // {width}) % 16"
        left = f"array_to_string(list_slice(p.kids, 1, {own}), '')"
        right = f"array_to_string(list_slice(p.kids, {own} + 2, 16), '')"
        same = "f.g IS NOT DISTINCT FROM p.g" if inner else "p.g = 0"
        ctes.append(
            f"f{i + 1} AS (SELECT f.* EXCLUDE (node, beside), CASE WHEN p.lone THEN node ELSE sha256({left} || node || {right}) END AS node, "
            f"CASE WHEN p.lone THEN beside ELSE beside || {left} || {right} END AS beside "
            f"FROM f{i} f JOIN {table} p ON {same} AND {at} // {width * 16} = p.idx)")
    return (
        "WITH " + ",\n".join(ctes) + "\nSELECT doc_id, leaf, subroot, root, sha256(beside) AS proof_sha256, node AS folded_root, "
        f"node = root AS verified FROM f{levels + source_levels}")


def oracle_sql() -> dict[str, str]:
    return {
        "op5_source_mix": MIX, "op6_line_dedup": LINES, "op7_suffix_array_dedup": REPEATS,
        "op11_chat_formatting": CHAT, "op12_merkle_manifest": _merkle()}
