"""DuckDB SQL of the corpus queries that SQL can express, over the same tables.

Left out, and held against brute force in tests/llm: SimHash (XXH64), the license
scan (hundreds of rules with suppression), suffix dedup (byte strings at every
place) and the pipeline (it contains SimHash).
"""

from __future__ import annotations

import hashlib

from revbridge.llm import quality_rules, sharding
from revbridge.llm.queries import (
    MIN_SITES, MIX_CYCLE, MIX_EPOCHS, N_SHARDS, NEIGHBOURS, PACK_BUCKETS, PACK_BUDGET, PACK_LEN, QUERY_EVERY, URL_RULES,
)

WORD = r"'[^\x20\x09-\x0D]+'"


def _words(text: str) -> str:
    return f"coalesce(len(regexp_extract_all({text}, {WORD})), 0)"


def _hash60(text: str) -> str:
    return f"('0x' || substr(md5({text}), 1, 15))::BIGINT"


def _lower(text: str) -> str:
    return f"translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _normal(line: str) -> str:
    return rf"trim(regexp_replace({_lower(line)}, '[\x20\x09-\x0D]+', ' ', 'g'), ' ')"


def slot_owners(shards: int, slots: int) -> list[int]:
    """The table by its definition: in every turn the next shard takes the first slot of its
    preference list that nobody has.  (A recursive query does the same, in minutes.)"""
    number = lambda text: int(hashlib.md5(text.encode()).hexdigest()[:15], 16)
    owners: dict[int, int] = {}
    lists = []
    for i in range(shards):
        start, step = number(f"start:shard-{i:05d}") % slots, number(f"step:shard-{i:05d}") % (slots - 1) + 1
        lists.append(iter(range(start, start + slots * step, step)))
    for turn in range(slots):
        owners[next(x % slots for x in lists[turn % shards] if x % slots not in owners)] = turn % shards
    return [owners[s] for s in range(slots)]


def sharding_sql(shards: int = N_SHARDS) -> str:
    """The table is a literal: it depends on parameters alone."""
    slots = sharding.prime_from(100 * shards)
    slot = f"{_hash60("coalesce(doc_id::VARCHAR, '~')")} % {slots}"
    return f"""
    SELECT doc_id, {slot} AS slot, 'shard-' || lpad(({slot_owners(shards, slots)})[{slot} + 1]::VARCHAR, 5, '0') AS shard FROM documents
    """


LINE_DEDUP = f"""
WITH lines AS (
  SELECT row, doc_id, source, unnest(split) AS line, generate_subscripts(split, 1) AS pos
  FROM (SELECT row_number() OVER () AS row, doc_id, source, string_split(text, chr(10)) AS split FROM documents)
), normal AS (SELECT *, {_normal('line')} AS norm FROM lines
), common AS (SELECT norm FROM normal WHERE norm <> '' GROUP BY norm HAVING count(DISTINCT source) >= {MIN_SITES}
), marked AS (SELECT n.*, c.norm IS NOT NULL AS gone FROM normal n LEFT JOIN common c ON n.norm = c.norm
), rest AS (
  SELECT row, any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed,
         coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS left_text
  FROM marked GROUP BY row
)
SELECT doc_id, n_lines, n_removed, length(left_text) AS n_chars_left, md5(left_text) AS text_md5 FROM rest
UNION ALL SELECT doc_id, 0, 0, NULL, NULL FROM documents WHERE text IS NULL
"""


def quality_sql() -> str:
    lim, w = quality_rules.Limits(), quality_rules.WINDOW
    return f"""
    WITH docs AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text, coalesce('s' || source, '') AS host FROM documents
    ), tokens AS (SELECT row, regexp_extract_all(text, {WORD}) AS words FROM docs
    ), windows AS (
      SELECT row, i, array_to_string(words[i : i + {w - 1}], ' ') AS win
      FROM (SELECT row, words, unnest(range(1, greatest(len(words) - {w - 1}, 0) + 1)) AS i FROM tokens)
    ), twice AS (SELECT row, i FROM (SELECT row, i, count(*) OVER (PARTITION BY row, win) AS n FROM windows) WHERE n > 1
    ), repeats AS (SELECT row, count(DISTINCT i + k) AS n_repeat_words FROM twice, range({w}) r(k) GROUP BY row
    ), lines AS (
      SELECT row, host, text, unnest(split) AS line, generate_subscripts(split, 1) AS pos
      FROM (SELECT row, host, text, string_split(text, chr(10)) AS split FROM docs)
    ), normal AS (
      SELECT *, {_normal('line')} AS norm, row_number() OVER (PARTITION BY row, line ORDER BY pos) AS nth,
             {_words('line')} AS n FROM lines
    ), dups AS (SELECT row, count(*) FILTER (nth > 1 AND n > 0) AS n_dup_lines FROM normal GROUP BY row
    ), placed AS (
      SELECT *, hash(coalesce(lag(norm) OVER (PARTITION BY row ORDER BY pos), chr(1)), coalesce(lead(norm) OVER (PARTITION BY row ORDER BY pos), chr(1))) AS around
      FROM normal
    ), often AS (SELECT host, norm FROM placed WHERE n > 0 GROUP BY ALL HAVING count(*) > {lim.min_documents}
    ), carried AS (
      SELECT host, norm, count(DISTINCT p.text) AS texts, count(DISTINCT (d.doc_id, p.text)) AS documents, count(DISTINCT around) AS spread
      FROM placed p JOIN (SELECT row, doc_id FROM docs) d USING (row) SEMI JOIN often USING (host, norm) GROUP BY ALL
    ), hosts AS (SELECT host, count(DISTINCT text) AS every, count(DISTINCT (doc_id, text)) AS all_documents FROM docs GROUP BY host
    ), counted AS (SELECT * FROM carried JOIN hosts USING (host) WHERE texts > {lim.min_documents} AND texts > every * {lim.max_share}
    ), rest AS (  -- what is left of each text without such lines, if enough is
      SELECT p.host, row, list_sort(coalesce(list(p.norm) FILTER (c.norm IS NULL), [])) AS rest, list_distinct(list(c.norm) FILTER (c.norm IS NOT NULL)) AS gone
      FROM placed p SEMI JOIN (SELECT min(row) AS row FROM docs GROUP BY host, text) o USING (row) LEFT JOIN counted c ON c.host = p.host AND c.norm = p.norm
      WHERE n > 0 GROUP BY ALL
      HAVING sum(n) FILTER (c.norm IS NOT NULL) <= sum(n) * {lim.max_removed} AND coalesce(sum(n) FILTER (c.norm IS NULL), 0) >= {lim.min_left}
    ), rests AS (SELECT host, norm, count(DISTINCT rest) AS rests FROM (SELECT host, rest, unnest(gone) AS norm FROM rest) GROUP BY ALL
    ), above AS (
      SELECT host, norm FROM counted LEFT JOIN rests USING (host, norm) WHERE greatest(spread, coalesce(rests, 0)) >= texts * {lim.min_spread}
      UNION SELECT host, norm FROM carried JOIN hosts USING (host) WHERE documents > {lim.min_documents} AND documents > all_documents * {lim.site_share}
    ), lost AS (SELECT row, sum(n)::BIGINT AS n_removed_words FROM placed SEMI JOIN above USING (host, norm) GROUP BY row
    ), measured AS (
      SELECT d.doc_id, len(words) AS n_words, coalesce(list_sum([length(x) FOR x IN words]), 0)::BIGINT AS word_chars,
             length(d.text) - length(regexp_replace(d.text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
             n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_removed_words, 0) AS n_removed_words
      FROM docs d JOIN tokens USING (row) JOIN dups USING (row) LEFT JOIN repeats USING (row) LEFT JOIN lost USING (row)
    ), judged AS (
      SELECT *, n_words < {quality_rules.MIN_WORDS} OR 100 * n_repeat_words > {quality_rules.MAX_REPEAT_PERCENT} * n_words AS base_failed FROM measured
    )
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT base_failed AND n_removed_words <= n_words * {lim.max_removed} AND n_words - n_removed_words >= {lim.min_left} AS kept,
           n_removed_words
    FROM judged
    """


def url_sql() -> str:
    host = _lower("coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), '')")
    path = "coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '')"
    canon = (
        r"regexp_replace(regexp_replace(host, ':[0-9]*$', ''), '^(www|m)\.', '') || "
        r"regexp_replace(regexp_replace(regexp_replace(path, '/index\.html?$', ''), '/+$', ''), '\.html?$', '')"
    )
    whens = "\n".join(
        f"WHEN (host = '{r.host}' OR suffix(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN '{r.name}'"
        for r in sorted(URL_RULES, key=lambda r: (-len(r.name), r.name))
    )
    verdicts = " ".join(f"WHEN '{r.name}' THEN '{r.verdict}'" for r in URL_RULES)
    return f"""
    WITH parts AS (SELECT page_id, {host} AS host, {path} AS path FROM pages
    ), canon AS (SELECT *, {canon} AS canonical_url, CASE {whens} END AS rule FROM parts
    ), listed AS (
      SELECT DISTINCT canonical_url FROM canon
      WHERE regexp_extract(canonical_url, '/([0-9]{{1,18}})$', 1) IN (SELECT doc_id::VARCHAR FROM labels WHERE toxic = 1)
    )
    SELECT page_id, host, path, rule,
           coalesce(CASE rule {verdicts} END, CASE WHEN canonical_url IN (SELECT canonical_url FROM listed) THEN 'block' ELSE 'allow' END) AS verdict
    FROM canon
    """


def mixing_sql() -> str:
    cycle = " ".join(f"WHEN {i} THEN {w}" for i, w in enumerate(MIX_CYCLE))
    return f"""
    WITH sized AS (SELECT doc_id, source, {_words('text')} AS size, md5(text) AS digest FROM documents
    ), sources AS (
      SELECT source, sum(size)::BIGINT AS source_size, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(MIX_CYCLE)} {cycle} END AS weight
      FROM sized GROUP BY source
    ), total AS (SELECT sum(source_size)::BIGINT AS t FROM sources
    ), clamped AS (  -- a source is clamped if the level that fills it does not use up the budget
      SELECT a.*, {MIX_EPOCHS} * a.source_size AS cap,
             (SELECT sum(least({MIX_EPOCHS} * b.source_size, {MIX_EPOCHS} * a.source_size * b.weight / a.weight)) FROM sources b) < (SELECT t FROM total) AS at_cap
      FROM sources a
    ), level AS (
      SELECT (SELECT t FROM total) - coalesce(sum(cap) FILTER (WHERE at_cap), 0) AS left_over, sum(weight) FILTER (WHERE NOT at_cap) AS weights FROM clamped
    ), targets AS (
      SELECT source, source_size, CASE WHEN at_cap THEN cap::DOUBLE ELSE left_over::DOUBLE * weight::DOUBLE / weights::DOUBLE END AS target FROM clamped, level
    ), needs AS (SELECT *, floor(target / nullif(source_size, 0)) AS whole, target - floor(target / nullif(source_size, 0)) * source_size AS need FROM targets
    ), ordered AS (
      SELECT *, {_hash60("concat_ws(':', 'mix', coalesce(doc_id::VARCHAR, '~'), size::VARCHAR, coalesce(digest, '~'))")} AS u FROM sized
    ), summed AS (
      SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY u, doc_id, size, digest ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM ordered
    )
    SELECT doc_id, size, source_size, target,
           ((coalesce(whole, 0) + CASE WHEN need > 0 AND 2 * before + size <= 2 * need THEN 1 ELSE 0 END) * size)::BIGINT AS taken
    FROM summed s JOIN needs n ON s.source IS NOT DISTINCT FROM n.source
    """


def packing_sql(n_buckets: int = PACK_BUCKETS) -> str:
    """The dynamic programme unrolled: one step per bucket over the distinct lengths."""
    steps = []
    for k in range(2, n_buckets + 1):
        steps.append(f"""
        dp{k} AS MATERIALIZED (
          SELECT j.pos, list_append(min_by(p.cuts, [p.cost + j.len * (j.c - i.c) - (j.s - i.s), i.pos]), j.len) AS cuts,
                 min(p.cost + j.len * (j.c - i.c) - (j.s - i.s)) AS cost
          FROM hist j JOIN hist i ON i.pos < j.pos JOIN dp{k - 1} p ON p.pos = i.pos WHERE j.pos >= {k} GROUP BY j.pos, j.len
        )""")
    every = " UNION ALL ".join(f"SELECT {k} AS k, cuts, cost FROM dp{k} WHERE pos = (SELECT max(pos) FROM hist)" for k in range(1, n_buckets + 1))
    return f"""
    WITH sized AS (SELECT doc_id, {_words('text')} AS n, md5(text) AS digest FROM documents
    ), pieces AS (
      SELECT doc_id, digest, piece, least({PACK_LEN}, n - piece * {PACK_LEN}) AS n_tokens
      FROM (SELECT doc_id, digest, n, unnest(range(0, greatest(0, (n - 1) // {PACK_LEN}) + 1)) AS piece FROM sized)
    ), hist AS MATERIALIZED (
      SELECT n_tokens AS len, row_number() OVER (ORDER BY n_tokens) AS pos, sum(count(*)) OVER (ORDER BY n_tokens)::BIGINT AS c,
             sum(count(*) * n_tokens) OVER (ORDER BY n_tokens)::BIGINT AS s
      FROM pieces GROUP BY n_tokens
    ), dp1 AS MATERIALIZED (SELECT pos, [len] AS cuts, len * c - s AS cost FROM hist),
    {','.join(steps)},
    best AS (SELECT cuts FROM ({every}) ORDER BY k DESC LIMIT 1),
    cut AS (SELECT unnest(cuts) AS bucket_len FROM best),
    placed AS (SELECT p.*, (SELECT min(bucket_len) FROM cut WHERE bucket_len >= p.n_tokens) AS bucket_len FROM pieces p),
    counted AS (
      SELECT *, row_number() OVER (PARTITION BY bucket_len ORDER BY
        {_hash60("concat_ws(':', 'pack', coalesce(doc_id::VARCHAR, '~'), piece::VARCHAR, coalesce(digest, '~'))")}, doc_id, piece, digest) - 1 AS place FROM placed
    )
    SELECT doc_id, piece, n_tokens, bucket_len, place // greatest(1, {PACK_BUDGET} // greatest(1, bucket_len)) AS batch, bucket_len - n_tokens AS padding
    FROM counted
    """


NEAREST = f"""
WITH good AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         list_inner_product(q.v, c.v) / (sqrt(list_inner_product(q.v, q.v)) * sqrt(list_inner_product(c.v, c.v))) AS score
  FROM good q JOIN good c ON q.vec_id % {QUERY_EVERY} = 0 AND q.vec_id <> c.vec_id
), ranked AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM pairs)
SELECT * FROM ranked WHERE rank <= {NEIGHBOURS}
"""


def oracle_sql() -> dict[str, str]:
    from revbridge.llm import oracle_models

    return {
        "op1_sharding": sharding_sql(),
        "op3_line_dedup": LINE_DEDUP,
        "op5_quality_rules": quality_sql(),
        "op6_url_filter": url_sql(),
        "op8_mixing": mixing_sql(),
        "op9_packing": packing_sql(),
        "op10_nearest": NEAREST,
        "op11_hard_negatives": oracle_models.HARD_NEGATIVES,
        "op12_manifest": oracle_models.manifest_sql(),
        "op13_lm_score": oracle_models.language_model_sql(),
    }
