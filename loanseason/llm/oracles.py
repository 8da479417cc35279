"""SQL twins of the queries of this folder, for DuckDB."""

from __future__ import annotations

from loanseason.llm.licences import TEMPLATES

_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

EXACT_DEDUP = f"""
WITH plain AS (SELECT doc_id, {_LOWERED} AS body FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(body) AS text_sha256
FROM plain WINDOW same AS (PARTITION BY body)
"""

MIXING = f"""
WITH sized AS (
    SELECT doc_id, source, len({_WORDS}) AS size, md5('mix:' || coalesce(doc_id::VARCHAR, '-')) AS ticket FROM documents
), per_source AS (
    SELECT source, sum(size)::BIGINT AS source_size, 3 * sum(size)::BIGINT AS lid,
           row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place
    FROM sized GROUP BY source
), weighed AS (
    SELECT *, [5, 2, 1][place % 3 + 1]::BIGINT AS heft, (sum(source_size) OVER ())::BIGINT AS everything FROM per_source
), filling AS (
    SELECT *, coalesce(sum(lid) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below,
           sum(heft) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_heft
    FROM weighed WINDOW w AS (ORDER BY lid / heft, place)
), full_or_not AS (
    SELECT *, heft * (everything - below) > lid * open_heft AS is_full FROM filling
), goals AS (
    SELECT source, place, source_size, everything, CASE WHEN is_full THEN lid::DOUBLE ELSE
           (heft * (everything - coalesce(sum(lid) FILTER (is_full) OVER (), 0)))::DOUBLE
           / (sum(heft) FILTER (NOT is_full) OVER ())::DOUBLE END AS target
    FROM full_or_not
), queue AS (
    SELECT doc_id, size, ticket, place, source_size, target, everything, epoch,
           CASE WHEN target > 0 THEN (epoch * source_size + sum(size) OVER (
               PARTITION BY place, epoch ORDER BY ticket, doc_id, size ROWS UNBOUNDED PRECEDING))::DOUBLE / target END AS finish
    FROM sized JOIN goals ON sized.source IS NOT DISTINCT FROM goals.source, range(3) AS r(epoch)
), served AS (
    SELECT *, sum(CASE WHEN finish IS NULL THEN 0 ELSE size END) OVER (
        ORDER BY finish NULLS LAST, place, epoch, ticket, doc_id, size ROWS UNBOUNDED PRECEDING) AS total_so_far FROM queue
)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       sum(CASE WHEN finish IS NOT NULL AND total_so_far <= everything THEN size ELSE 0 END)::BIGINT AS taken
FROM served GROUP BY doc_id, size, source_size, target, place, ticket
"""

TOP_K = """
WITH whole AS (
    SELECT vec_id, [floor(256 * x::DOUBLE) FOR x IN embedding] AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND coalesce(list_bool_and([x IS NOT NULL AND isfinite(x) FOR x IN embedding]), true)
), scored AS (
    SELECT q.vec_id AS query_id, p.vec_id, list_inner_product(q.v, p.v)::BIGINT AS score
    FROM whole q JOIN whole p ON q.vec_id % 50 = 0 AND p.vec_id <> q.vec_id AND len(p.v) = len(q.v)
)
SELECT query_id, place::INTEGER AS rank, vec_id, score FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM scored
) WHERE place <= 5
"""

SUBSTRING_DEDUP = f"""
WITH split AS (SELECT doc_id, row_number() OVER () AS line, {_WORDS} AS w FROM documents),
starts AS (
    SELECT line, pos, array_to_string(w[pos:pos + 34], ' ') AS phrase FROM split, range(1, len(w) - 33) AS r(pos)
), again AS (
    SELECT line, pos FROM starts QUALIFY count(*) OVER (PARTITION BY phrase) > 1
), gone AS (
    SELECT DISTINCT line, pos + step AS place FROM again, range(35) AS s(step)
), per_line AS (
    SELECT split.line, list(place) AS places FROM split JOIN gone USING (line) GROUP BY split.line
)
SELECT doc_id, len(w) AS n_words, coalesce(len(places), 0)::BIGINT AS n_removed,
       sha256(array_to_string([w[i] FOR i IN range(1, len(w) + 1) IF places IS NULL OR NOT list_contains(places, i)], ' ')) AS kept_sha256
FROM split LEFT JOIN per_line USING (line)
"""

_TEMPLATE_ROWS = ", ".join(f"({k}, '{name}', '{text}')" for k, (name, text) in enumerate(TEMPLATES))
_TERMS = "list_filter(regexp_split_to_array(lower({}), '[^a-z0-9]+'), lambda t: t <> '')"

LICENSE_SCAN = f"""
WITH template(no, license, wording) AS (VALUES {_TEMPLATE_ROWS}),
files AS (
    SELECT doc_id, coalesce(text, '') AS body, concat_ws('/', coalesce(source, '_'), coalesce(lang, '_')) AS folder,
           concat_ws('/', coalesce(source, '_'), coalesce(lang, '_'), doc_id::VARCHAR) AS path FROM documents
), template_terms AS (
    SELECT no, license, term, count(*) AS n FROM (SELECT no, license, unnest({_TERMS.format("wording")}) AS term FROM template)
    GROUP BY ALL
), bags AS (SELECT doc_id, list_distinct({_TERMS.format("body")}) AS bag FROM files),
frequency AS (
    SELECT term, count(*) AS df FROM (SELECT unnest(bag) AS term FROM bags) SEMI JOIN template_terms USING (term) GROUP BY term
), rare AS (
    SELECT DISTINCT term, ln(((SELECT count(*) FROM files) + 1) / (coalesce(df, 0) + 1)) + 1 AS idf
    FROM template_terms LEFT JOIN frequency USING (term)
), goal AS (
    SELECT no, license, term, n * idf / sqrt(sum(n * idf * n * idf) OVER (PARTITION BY no)) AS weight
    FROM template_terms JOIN rare USING (term)
), runs AS (
    SELECT doc_id, array_to_string(lines[start_no:start_no + width - 1], chr(10)) AS line, 10 * start_no + width AS place
    FROM (SELECT doc_id, string_split(body, chr(10)) AS lines FROM files), range(1, len(lines) + 1) AS a(start_no), range(1, 9) AS b(width)
    WHERE start_no + width - 1 <= len(lines)
), pieces AS (
    SELECT * FROM runs UNION ALL SELECT doc_id, body, -1 FROM files
), counted AS (
    SELECT doc_id, place, term, count(*) AS n FROM (
        SELECT doc_id, place, unnest({_TERMS.format("line")}) AS term FROM pieces WHERE regexp_matches(line, '(?i)(licen|permission|redistribut|software|copyright|mozilla|creative)')
    ) GROUP BY ALL
), valued AS (
    SELECT doc_id, place, term, n * coalesce(idf, ln((SELECT count(*) FROM files) + 1) + 1) AS value FROM counted LEFT JOIN rare USING (term)
), lengths AS (SELECT doc_id, place, sqrt(sum(value * value)) AS size FROM valued GROUP BY ALL),
scores AS (
    SELECT doc_id, place, license, round(sum(value * weight) / any_value(size), 9) AS score
    FROM valued JOIN goal USING (term) JOIN lengths USING (doc_id, place) GROUP BY doc_id, place, no, license
), own AS (
    SELECT doc_id, license AS own_license, score AS own_score FROM scores WHERE score >= 0.6
    QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, license, place) = 1
), judged AS (SELECT * FROM files LEFT JOIN own USING (doc_id)),
stated AS (
    SELECT folder, arg_min(own_license, path) AS folder_license, min(path) AS folder_path FROM judged
    WHERE own_license IS NOT NULL GROUP BY folder
)
SELECT doc_id, own_license, round(own_score, 6) AS own_score, coalesce(own_license, folder_license) AS license,
       CASE WHEN own_license IS NULL THEN folder_path ELSE path END AS license_path
FROM judged LEFT JOIN stated USING (folder)
"""

NEAR_DEDUP = f"""
WITH RECURSIVE split AS MATERIALIZED (
    SELECT doc_id, regexp_extract_all({_LOWERED}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), bags AS MATERIALIZED (
    SELECT doc_id, CASE len(w) WHEN 0 THEN [] WHEN 1 THEN w
           ELSE list_distinct([w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]) END AS bag FROM split
), numbered AS MATERIALIZED (SELECT doc_id, len(bag) AS size, unnest(bag) AS shingle FROM bags),
links AS MATERIALIZED (
    SELECT a.doc_id AS x, b.doc_id AS y FROM numbered a JOIN numbered b USING (shingle)
    WHERE a.doc_id < b.doc_id AND 5 * a.size >= 4 * b.size AND 5 * b.size >= 4 * a.size
    GROUP BY x, y, a.size, b.size HAVING 100 * count(*) >= 80 * (a.size + b.size - count(*))
), sides AS MATERIALIZED (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach(doc_id, other) AS (
    SELECT doc_id, doc_id FROM bags UNION SELECT reach.doc_id, sides.y FROM reach JOIN sides ON sides.x = reach.other
)
SELECT doc_id, any_value(len(bag))::BIGINT AS n_shingles, min(other) AS component_id, doc_id = min(other) AS kept
FROM reach JOIN bags USING (doc_id) GROUP BY doc_id
"""

_PLAIN_WORDS = f"regexp_extract_all({_LOWERED}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

DECONTAMINATE = f"""
WITH doc AS MATERIALIZED (SELECT doc_id, row_number() OVER () AS line, {_PLAIN_WORDS} AS w FROM documents),
item AS (SELECT item_id, {_PLAIN_WORDS} AS w FROM benchmark),
item_runs AS MATERIALIZED (
    SELECT DISTINCT item_id, least(10, len(w)) AS size, array_to_string(w[pos:pos + least(10, len(w)) - 1], ' ') AS run
    FROM item, range(1, len(w) - least(10, len(w)) + 2) AS r(pos) WHERE len(w) > 0
), sizes AS (SELECT DISTINCT size FROM item_runs),
doc_runs AS (
    SELECT line, size, pos, array_to_string(w[pos:pos + size - 1], ' ') AS run FROM doc, sizes, range(1, len(w) - size + 2) AS r(pos)
), met AS MATERIALIZED (SELECT line, pos, size, item_id FROM doc_runs JOIN item_runs USING (size, run)),
places AS (
    SELECT line, count(DISTINCT pos + step) AS n_hit FROM met, range(size) AS s(step) GROUP BY line
), named AS (
    SELECT line, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT line, item_id::VARCHAR AS item FROM met WHERE item_id IS NOT NULL) GROUP BY line
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM doc LEFT JOIN places USING (line) LEFT JOIN named USING (line)
"""

_SEARCH_TERMS = f"regexp_extract_all({_LOWERED}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"

RANKED_SEARCH = f"""
WITH doc AS MATERIALIZED (SELECT doc_id, row_number() OVER () AS line, {_SEARCH_TERMS} AS w FROM documents),
whole AS (SELECT count(*) AS docs, sum(len(w))::BIGINT AS terms FROM doc WHERE len(w) > 0),
held AS MATERIALIZED (SELECT line, term, count(*) AS tf FROM (SELECT line, unnest(w) AS term FROM doc) GROUP BY ALL),
asked AS (SELECT DISTINCT item_id, term FROM (SELECT item_id, unnest({_SEARCH_TERMS}) AS term FROM benchmark)),
weights AS (
    SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS weight
    FROM held SEMI JOIN asked USING (term), whole GROUP BY term, docs
), parts AS (
    SELECT line, term, weight * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * len(w) * docs) // terms))) AS part
    FROM held JOIN weights USING (term) JOIN doc USING (line), whole
), scores AS (SELECT item_id, line, sum(part)::BIGINT AS score FROM asked JOIN parts USING (term) GROUP BY item_id, line HAVING score > 0)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM scores JOIN doc USING (line) QUALIFY rank <= 10
"""

COLLOCATIONS = f"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWERED}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents
), split AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
counts AS MATERIALIZED (
    SELECT lang, w[pos:pos + size - 1] AS words, count(*) AS f
    FROM (SELECT lang, w, unnest(range(1, 5)) AS size FROM split), range(1, len(w) - size + 2) AS r(pos)
    GROUP BY ALL HAVING size = 1 OR f >= 30
), totals AS (SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE len(words) = 1 GROUP BY lang),
candidates AS MATERIALIZED (SELECT lang, words, f AS a FROM counts WHERE len(words) > 1 AND f >= 30),
cuts AS (
    SELECT c.lang, c.words, a, k, p.f AS l, q.f AS r, (2000000::HUGEINT * a) // (p.f + q.f) AS score
    FROM (SELECT *, unnest(range(1, len(words))) AS k FROM candidates) c
    JOIN counts p ON p.lang = c.lang AND p.words = c.words[1:k]
    JOIN counts q ON q.lang = c.lang AND q.words = c.words[k + 1:]
), best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, words ORDER BY score, k) = 1),
covered AS (
    SELECT lang, words[pos:pos + size - 1] AS words, max(a) AS longer
    FROM (SELECT *, unnest(range(2, len(words))) AS size FROM candidates), range(1, len(words) - size + 2) AS r(pos) GROUP BY ALL
), ranked AS (
    SELECT lang, array_to_string(words, ' ') AS phrase, a, l, r, score::BIGINT AS score
    FROM best LEFT JOIN covered USING (lang, words) WHERE longer IS NULL OR 100::HUGEINT * longer < 80::HUGEINT * a
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM ranked JOIN totals USING (lang)
QUALIFY rank <= 2000
"""

ORACLES = {
    "op1_exact_dedup": EXACT_DEDUP,
    "op2_exact_top_k": TOP_K,
    "op4_substring_dedup": SUBSTRING_DEDUP,
    "op5_minhash_near_dedup": NEAR_DEDUP,
    "op6_license_scan": LICENSE_SCAN,
    "op10_mixing": MIXING,
    "op11_ranked_search": RANKED_SEARCH,
    "op12_collocations": COLLOCATIONS,
    "op13_decontaminate": DECONTAMINATE,
}
