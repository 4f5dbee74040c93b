"""DuckDB SQL of the operators that SQL can express."""

from __future__ import annotations

from ledgerlens.llm.secrets import RULES

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

NEAR_DUPLICATES = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(ws) >= 2 THEN list_distinct(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]))
                      ELSE ws END AS sh FROM w
), e AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS x FROM s
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.x = b.x AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links
), reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, l.b FROM reach r JOIN both_ways l ON r.other = l.a
), least AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT s.doc_id, len(s.sh)::BIGINT AS n_shingles, component_id, s.doc_id = component_id AS kept FROM s JOIN least USING (doc_id)
"""


def _secrets() -> str:
    parts, columns = [], []
    for rank, r in enumerate(RULES):
        pattern = f"{r.pattern[:-1]}{{{r.least},}}" if r.kind == "hex" else r.pattern
        quoted = "'" + pattern.replace("'", "''") + "'"
        parts.append(f"""m{rank} AS (SELECT *, regexp_extract_all(t, {quoted}, 0) AS m{rank}, regexp_extract_all(t, {quoted}, {r.group}) AS c{rank},
  string_split_regex(t, {quoted}) AS g{rank} FROM {f'm{rank - 1}' if rank else 'd'})""")
        columns.append(f"""list_filter(list_transform(range(1, len(m{rank}) + 1), lambda i: {{
    's': list_sum(list_transform(g{rank}[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m{rank}[1:i - 1], lambda x: length(x))), 0),
    'r': {rank}, 'n': length(m{rank}[i]), 'k': '{r.kind}', 'ok': length(c{rank}[i]) >= {r.least}}}), lambda z: z.ok)""")
    said = "array_to_string(list_transform({}, lambda z: z.k || ':' || z.s::BIGINT || ':' || (z.s + z.n)::BIGINT), ',')"
    base = [i for i, r in enumerate(RULES) if r.base]
    counts = ", ".join(f"len(list_filter(base, lambda z: z.r = {i}))::BIGINT AS n_{RULES[i].kind}" for i in base)
    return f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), {', '.join(parts)},
a AS (SELECT doc_id, list_sort(list_concat({', '.join(columns)})) AS spans FROM m{len(RULES) - 1}),
b AS (SELECT doc_id, spans, list_filter(spans, lambda z: z.r < {len(base)}) AS base FROM a)
SELECT doc_id, {counts}, sha256({said.format('base')}) AS base_sha256, {said.format('spans')} AS spans FROM b"""


SECRETS = _secrets()

TOP_K = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS query_id, b.vec_id, list_inner_product(a.q, b.q)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 10
"""


MERKLE_LEVELS = 8  # of either tree: 8 ** 8 leaves a language


def _merkle() -> str:
    def field(c: str) -> str:
        return f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR END"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(field(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"

    # crc32 of the decimal id, bit by bit: each byte is followed by seven steps without one
    steps = ("list_concat([4294967295], flatten(list_transform(range(1, length(doc_id::VARCHAR) + 1), "
             "lambda i: [ascii((doc_id::VARCHAR)[i])::BIGINT, 0, 0, 0, 0, 0, 0, 0])))")
    step = "CASE WHEN xor(c, x) % 2 = 1 THEN xor(xor(c, x) >> 1, 3988292384) ELSE xor(c, x) >> 1 END"
    crc = f"xor(list_reduce({steps}, lambda c, x: {step}), 4294967295)"
    parts = [f"""d AS MATERIALIZED (SELECT *, row_number() OVER () AS uid, {leaf('text')} AS leaf,
  CASE WHEN doc_id IS NOT NULL AND {crc} % 3 = 0 THEN {leaf(f"translate(text, '{UPPER}', '{LOWER}')")} ELSE {leaf('text')} END AS claimed FROM documents)""",
             "t0 AS MATERIALIZED (SELECT uid, coalesce('l' || lang, '') AS tree, leaf AS hash, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, uid) - 1 AS pos FROM d)"]

    def levels(t: str) -> None:
        """t0(tree, pos, hash): runs of every level, and what remains of every tree."""
        for i in range(MERKLE_LEVELS):
            parts.append(f"{t}r{i + 1} AS MATERIALIZED (SELECT tree, pos // 8 AS run, list(hash ORDER BY pos) AS hashes FROM "
                         f"(SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM {t}{i}) WHERE n > 1 GROUP BY tree, pos // 8)")
            parts.append(f"{t}{i + 1} AS MATERIALIZED (SELECT tree, run AS pos, sha256(array_to_string(hashes, '')) AS hash FROM {t}r{i + 1} "
                         f"UNION ALL SELECT tree, pos, hash FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM {t}{i}) WHERE n = 1)")

    levels("t")
    parts.append(f"u0 AS MATERIALIZED (SELECT '' AS tree, tree AS own, hash, row_number() OVER (ORDER BY tree) - 1 AS pos FROM t{MERKLE_LEVELS})")
    levels("u")
    parts.append("f0 AS MATERIALIZED (SELECT t0.uid, t0.tree, t0.pos, claimed AS h, '' AS proof FROM t0 JOIN d USING (uid))")
    n = 0
    for t in "tu":
        for i in range(1, MERKLE_LEVELS + 1):
            n += 1
            at = "f.pos % 8"
            parts.append(f"""f{n} AS MATERIALIZED (SELECT f.uid, f.tree, f.pos // 8 AS pos,
  CASE WHEN r.run IS NULL THEN h ELSE sha256(array_to_string(list_transform(hashes, lambda x, i: CASE WHEN i - 1 = {at} THEN h ELSE x END), '')) END AS h,
  CASE WHEN r.run IS NULL THEN proof ELSE proof || array_to_string(list_filter(hashes, lambda x, i: i - 1 <> {at}), '') END AS proof
  FROM f{n - 1} f LEFT JOIN {t}r{i} r ON r.tree = f.tree AND r.run = f.pos // 8)""")
        if t == "t":
            n += 1
            parts.append(f"f{n} AS MATERIALIZED (SELECT f.uid, '' AS tree, u0.pos, h, proof FROM f{n - 1} f JOIN u0 ON u0.own = f.tree)")
    return f"""WITH {", ".join(parts)}
SELECT d.doc_id, d.leaf, s.hash AS subroot, r.hash AS root, sha256(f{n}.proof) AS proof_sha256, f{n}.h AS folded_root, f{n}.h = r.hash AS verified
FROM d JOIN f{n} USING (uid) JOIN t{MERKLE_LEVELS} s ON s.tree = coalesce('l' || d.lang, '') CROSS JOIN u{MERKLE_LEVELS} r"""


MERKLE = _merkle()
