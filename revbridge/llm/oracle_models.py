"""DuckDB SQL of the manifest, the hard negatives and the language model."""

from __future__ import annotations

from revbridge.llm.ngram_lm import PRIOR, STEPS
from revbridge.llm.oracle import WORD, _lower


def crc32(text: str) -> str:
    """CRC-32 of a short ASCII text, bit by bit."""
    bits = "list_reduce(range(8)::UBIGINT[], lambda p, q: xor(p >> 1, (p & 1) * 3988292384::UBIGINT), xor(a, b))"
    codes = f"list_transform(string_split({text}, ''), lambda c: ascii(c)::UBIGINT)"
    return f"xor(4294967295::UBIGINT, list_reduce({codes}, lambda a, b: {bits}, 4294967295::UBIGINT))"


def _leaf(text: str) -> str:
    part = "coalesce(strlen({0}::VARCHAR)::VARCHAR || ':' || {0}::VARCHAR, '-')"
    return "sha256(" + " || ".join(part.format(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


def manifest_sql(fanout: int = 8) -> str:
    parents = f"list_transform(range(0, (len(nodes) + {fanout - 1}) // {fanout}), lambda i: sha256(array_to_string(nodes[i * {fanout} + 1 : i * {fanout} + {fanout}], '')))"
    before = f"array_to_string(t.nodes[w.pos // {fanout} * {fanout} + 1 : w.pos], '')"
    after = f"array_to_string(t.nodes[w.pos + 2 : w.pos // {fanout} * {fanout} + {fanout}], '')"
    step = f"w.level + 1, w.pos // {fanout}, sha256({before} || w.acc || {after}), w.proof || {before} || {after}"
    return f"""
    WITH RECURSIVE leaves AS (
      SELECT row_number() OVER () AS row, doc_id, lang, {_leaf('text')} AS leaf,
             CASE WHEN {crc32('doc_id::VARCHAR')} % 3 = 0 THEN {_leaf(_lower('text'))} ELSE {_leaf('text')} END AS other
      FROM documents
    ), placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaves
    ), low(g, level, nodes) AS (
      SELECT lang, 0, list(leaf ORDER BY pos) FROM placed GROUP BY lang
      UNION ALL SELECT g, level + 1, {parents} FROM low WHERE len(nodes) > 1
    ), sub AS (SELECT g, nodes[1] AS subroot, row_number() OVER (ORDER BY g NULLS FIRST) - 1 AS pos FROM low WHERE len(nodes) = 1
    ), up(level, nodes) AS (
      SELECT 0, list(subroot ORDER BY pos) FROM sub
      UNION ALL SELECT level + 1, {parents} FROM up WHERE len(nodes) > 1
    ), walk(row, g, level, pos, acc, proof) AS (
      SELECT row, lang, 0, pos, other, '' FROM placed
      UNION ALL SELECT w.row, w.g, {step} FROM walk w JOIN low t ON t.g IS NOT DISTINCT FROM w.g AND t.level = w.level AND len(t.nodes) > 1
    ), climbed AS (
      SELECT w.row, s.subroot, s.pos, w.acc, w.proof FROM walk w JOIN low t ON t.g IS NOT DISTINCT FROM w.g AND t.level = w.level AND len(t.nodes) = 1
      JOIN sub s ON s.g IS NOT DISTINCT FROM w.g
    ), rise(row, level, pos, acc, proof) AS (
      SELECT row, 0, pos, acc, proof FROM climbed
      UNION ALL SELECT w.row, {step} FROM rise w JOIN up t ON t.level = w.level AND len(t.nodes) > 1
    )
    SELECT l.doc_id, l.leaf, c.subroot, t.nodes[1] AS root, sha256(w.proof) AS proof_sha256, w.acc AS folded_root, w.acc = t.nodes[1] AS verified
    FROM rise w JOIN up t ON t.level = w.level AND len(t.nodes) = 1 JOIN leaves l ON l.row = w.row JOIN climbed c ON c.row = w.row
    """


def language_model_sql() -> str:
    """Pairs by a window over each document's tokens; the start of a document is the null word."""
    return f"""
    WITH docs AS (
      SELECT row_number() OVER () AS row, doc_id, coalesce({crc32('doc_id::VARCHAR')} % 7 = 2, false) AS held_out,
             list_append(regexp_extract_all({_lower("coalesce(text, '')")}, {WORD}), '') AS words FROM documents
    ), tokens AS (SELECT row, held_out, unnest(words) AS w, generate_subscripts(words, 1) AS i FROM docs
    ), pairs AS (SELECT *, lag(w) OVER (PARTITION BY row ORDER BY i) AS v FROM tokens
    ), counts AS MATERIALIZED (SELECT w, count(*) AS c FROM tokens WHERE NOT held_out GROUP BY w
    ), totals AS (SELECT coalesce(sum(c), 0)::BIGINT AS n, count(*) AS d FROM counts
    ), contexts AS (SELECT w AS v, c AS total FROM counts WHERE w <> '' UNION ALL SELECT NULL, c FROM counts WHERE w = ''
    ), shares AS (
      SELECT p.v, p.w, pow(10, -floor(-log10(count(*) / (any_value(x.total) + {PRIOR})) * {STEPS} + 0.5) / {STEPS}) AS share
      FROM pairs p JOIN contexts x ON x.v IS NOT DISTINCT FROM p.v WHERE NOT p.held_out GROUP BY p.v, p.w
    ), each AS (
      SELECT p.row, c.c, (coalesce(c.c, 0) + 1) / (t.n + t.d + 1) AS alone,
             coalesce(s.share, 0) + CASE WHEN x.total > 0 THEN {PRIOR} / (x.total + {PRIOR}) ELSE 1 END * (coalesce(c.c, 0) + 1) / (t.n + t.d + 1) AS p
      FROM pairs p CROSS JOIN totals t LEFT JOIN counts c ON c.w = p.w LEFT JOIN contexts x ON x.v IS NOT DISTINCT FROM p.v
      LEFT JOIN shares s ON s.v IS NOT DISTINCT FROM p.v AND s.w = p.w
    ), summed AS (SELECT row, count(*) AS n_tokens, count(c) AS n_known, fsum(log10(alone)) AS base_score, fsum(log10(p)) AS score FROM each GROUP BY row)
    SELECT d.doc_id, d.held_out, s.n_tokens, s.n_known, t.n AS train_tokens, s.base_score, s.score
    FROM summed s JOIN docs d ON d.row = s.row CROSS JOIN totals t
    """


HARD_NEGATIVES = """
WITH good AS MATERIALIZED (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM good a JOIN good b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.positive_id, row_number() OVER w::INTEGER AS rank, n.vec_id AS negative_id, p.positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same AND 30 * p.positive_score <= 100 * n.score AND 100 * n.score <= 90 * p.positive_score
WINDOW w AS (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id) QUALIFY row_number() OVER w <= 10
"""
