"""DuckDB SQL of the operators that SQL can express whole, beside the older ones in ``queries``."""

from __future__ import annotations

PHRASES_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
seqs AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda x: x <> '') AS w FROM pieces),
places AS (
  SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM seqs),
grams AS (
  SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase, count(*) AS f
  FROM places, (VALUES (1), (2), (3), (4)) AS lengths(m)
  WHERE i + m - 1 <= len(w)
  GROUP BY ALL),
totals AS (
  SELECT lang, sum(f) AS n FROM grams WHERE m = 1 GROUP BY lang),
cand AS (
  SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM grams WHERE m > 1 AND f >= 30),
cuts AS (
  SELECT c.lang, c.m, c.phrase, c.a, k, x.f AS l, y.f AS r,
         (2000000::HUGEINT * c.a) // (x.f::HUGEINT + y.f::HUGEINT) AS score
  FROM (SELECT *, unnest(range(1, m)) AS k FROM cand) c
  JOIN grams x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:k], ' ') AND x.m = k
  JOIN grams y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[k + 1:], ' ') AND y.m = c.m - k),
worst AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_phrases AS (
  SELECT lang, array_to_string(w[i:i + s - 1], ' ') AS phrase, max(a) AS most
  FROM (SELECT *, unnest(range(1, m + 1)) AS i FROM cand), (VALUES (2), (3)) AS sizes(s)
  WHERE s < m AND i + s - 1 <= m
  GROUP BY ALL),
staying AS (
  SELECT v.* FROM worst v LEFT JOIN inner_phrases p ON v.lang = p.lang AND v.phrase = p.phrase
  WHERE p.most IS NULL OR 100::HUGEINT * p.most < 80::HUGEINT * v.a),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM staying)
SELECT s.lang, s.rank::BIGINT AS rank, s.phrase, s.a::BIGINT AS a, s.l::BIGINT AS l, s.r::BIGINT AS r, t.n::BIGINT AS n, s.score::BIGINT AS score
FROM ranked s JOIN totals t ON s.lang = t.lang
WHERE s.rank <= 2000
"""


def _manifest_levels(name: str, base: str, levels: int) -> str:
    """CTEs ``name_k`` of the nodes (tree, pos, d) of each level over ``base``, with siblings as before and after."""
    out = [f"{name}_0 AS (SELECT tree, pos, d FROM {base})"]
    for k in range(levels + 1):
        run = "OVER (PARTITION BY tree, pos // 8 ORDER BY pos ROWS BETWEEN"
        out.append(
            f"""{name}s_{k} AS (
  SELECT tree, pos, d, count(*) OVER (PARTITION BY tree) > 1 AS more,
         coalesce(string_agg(d, '') {run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
         coalesce(string_agg(d, '') {run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
  FROM {name}_{k})"""
        )
        if k < levels:
            out.append(
                f"""{name}_{k + 1} AS (
  SELECT tree, pos // 8 AS pos, CASE WHEN bool_or(more) THEN sha256(string_agg(d, '' ORDER BY pos)) ELSE any_value(d) END AS d
  FROM {name}s_{k} GROUP BY tree, pos // 8)"""
            )
    return ",\n".join(out)


def _manifest_climb(name: str, start: str, levels: int) -> str:
    """CTEs that carry proof and folded digest of ``start`` (tree, pos, fold, proof, ...) up the levels of ``name``."""
    out, last = [], start
    for k in range(levels + 1):
        out.append(
            f"""{name}c_{k} AS (
  SELECT c.* REPLACE (c.pos // 8 AS pos,
                      CASE WHEN s.more THEN sha256(s.before || c.fold || s.after) ELSE c.fold END AS fold,
                      CASE WHEN s.more THEN c.proof || s.before || s.after ELSE c.proof END AS proof)
  FROM {last} c JOIN {name}s_{k} s ON c.tree = s.tree AND c.pos = s.pos)"""
        )
        last = f"{name}c_{k}"
    return ",\n".join(out)


def manifest_sql(levels: int = 10, lang_levels: int = 4) -> str:
    """The Merkle manifest, level by level: 8**levels rows a language and 8**lang_levels languages."""
    field = lambda c: f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR) || ':' || {c}::VARCHAR END"
    leaf = lambda text: "sha256(" + " || ".join(map(field, ("doc_id", "source", "lang", "n_chars", text))) + ")"
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    # CRC-32 bit by bit (reflected polynomial 0xEDB88320) over the digits of the id
    crc = """xor(4294967295, list_reduce([4294967295] || list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT),
             lambda s, b: list_reduce([xor(s, b), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))))"""
    return f"""
WITH leaves AS (
  SELECT coalesce('+' || lang, '') AS tree, doc_id, {leaf('text')} AS leaf,
         CASE WHEN doc_id IS NOT NULL AND ({crc}) % 3 = 0 THEN {leaf(lowered)} END AS tampered
  FROM documents),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, leaf AS d FROM leaves),
{_manifest_levels("n", "placed", levels)},
subroots AS (
  SELECT tree AS name, '' AS tree, row_number() OVER (ORDER BY tree) - 1 AS pos, d FROM n_{levels}),
{_manifest_levels("u", "subroots", lang_levels)},
begun AS (
  SELECT tree, pos, doc_id, leaf, coalesce(tampered, leaf) AS fold, '' AS proof FROM placed),
{_manifest_climb("n", "begun", levels)},
crossed AS (
  SELECT s.tree, s.pos, c.doc_id, c.leaf, c.fold, c.proof, s.d AS subroot FROM nc_{levels} c JOIN subroots s ON c.tree = s.name),
{_manifest_climb("u", "crossed", lang_levels)}
SELECT doc_id, leaf, subroot, r.d AS root, sha256(proof) AS proof_sha256, fold AS folded_root, fold = r.d AS verified
FROM uc_{lang_levels} c, u_{lang_levels} r
"""
