"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

from tidemark.llm import op06_spaced as op06
from tidemark.llm import op10_diagonal as op10
from tidemark.llm import op11_multiindex as op11
from tidemark.llm import op12_centroids as op12
from tidemark.llm import op13_bitsliced as op13

#: The lower-cased alphanumeric words of ``text``, as in ``common.alnum_words``.
WORDS = r"regexp_extract_all(lower(replace(replace(coalesce(text, ''), chr(8490), 'µ'), 'İ', 'µ')), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def spaced_seeds() -> str:
    every = [*op06.MASKS, *["1" * n for n in range(op06.FEWEST, op06.SPAN)]]
    masks = " UNION ALL ".join(f"SELECT {m} AS m, {len(mask)} AS span, {[i for i, bit in enumerate(mask) if bit == '1']} AS offs" for m, mask in enumerate(every))
    return f"""WITH masks AS ({masks}),
    items AS (SELECT * FROM (SELECT DISTINCT item_id, {WORDS} AS w FROM benchmark) WHERE len(w) >= {op06.FEWEST}),
    seeds AS (SELECT item_id, w, m, q, list_transform(offs, lambda o: w[q + o]) AS key
        FROM (SELECT *, unnest(generate_series(1, len(w) - span + 1)) AS q FROM items JOIN masks ON span = least(len(w), {op06.SPAN}))),
    used AS (SELECT * FROM masks WHERE m IN (SELECT m FROM seeds)),
    docs AS (SELECT doc_id, hash(text) AS text_hash, {WORDS} AS w FROM documents),
    spots AS (SELECT doc_id, text_hash, w, m, p, list_transform(offs, lambda o: w[p + o]) AS key FROM (SELECT *, unnest(generate_series(1, len(w) - span + 1)) AS p FROM docs JOIN used ON span <= len(w))),
    hits AS (SELECT d.doc_id, d.text_hash, i.item_id, len(i.w) AS item_words, p - q AS diagonal,
        least(p - 1, q - 1, {op06.AROUND}) + least({op06.SPAN + op06.AROUND}, len(d.w) - p + 1, len(i.w) - q + 1) AS compared,
        len(list_filter(range(-least(p - 1, q - 1, {op06.AROUND}), least({op06.SPAN + op06.AROUND}, len(d.w) - p + 1, len(i.w) - q + 1)), lambda o: d.w[p + o] = i.w[q + o])) AS matched
        FROM spots d JOIN seeds i USING (m, key)),
    best AS (SELECT doc_id, text_hash, item_id, max(matched) AS matched, max(compared) AS compared, max(item_words) AS item_words,
        min(diagonal) FILTER (matched >= least({op06.LEAST}, ceil({op06.SHARE} * item_words))) AS diagonal FROM hits GROUP BY ALL)
    SELECT doc_id, item_id, CAST(diagonal AS BIGINT) AS start_word, CAST(matched AS BIGINT) AS matched, CAST(compared AS BIGINT) AS compared, CAST(item_words AS BIGINT) AS item_words FROM best WHERE diagonal IS NOT NULL"""


def diagonal_voting() -> str:
    rows = []
    for t, (text, label) in enumerate(op10.BASE + op10.TEMPLATES):
        words = op10.template_words(text)
        rows += [f"({t}, {q}, '{' '.join(words[q : q + op10.K])}', '{label}', {len(words) - op10.K + 1}, {str(t < len(op10.BASE)).upper()})" for q in range(len(words) - op10.K + 1)]
    named = lambda cond: f"coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER ({cond}), '')"
    return f"""WITH grams(template, q, gram, label, n_grams, is_base) AS (VALUES {', '.join(rows)}),
    docs AS (SELECT row_number() OVER () AS r, doc_id, {WORDS} AS w FROM documents),
    hits AS (SELECT r, p, template, q, label, n_grams, is_base FROM (SELECT r, p - 1 AS p, array_to_string(w[p : p + {op10.K - 1}], ' ') AS gram FROM (SELECT r, w, unnest(generate_series(1, len(w) - {op10.K - 1})) AS p FROM docs)) JOIN grams USING (gram)),
    votes AS (SELECT r, template, label, n_grams, is_base, p - q AS diagonal, count(*) AS votes, min(p) AS low, max(p) AS high FROM hits GROUP BY ALL),
    steps AS (SELECT *, CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY r, template ORDER BY diagonal) <= {op10.SLIP} THEN 0 ELSE 1 END AS step FROM votes),
    bands AS (SELECT *, CASE WHEN is_base THEN diagonal ELSE sum(step) OVER (PARTITION BY r, template ORDER BY diagonal) END AS band FROM steps),
    spans AS (SELECT r, template, label, n_grams, is_base, band, least(sum(votes) / n_grams, 1.0) AS coverage, min(diagonal) AS diagonal, min(low) AS low, max(high) AS high FROM bands GROUP BY r, template, label, n_grams, is_base, band),
    judged AS (SELECT *, CASE WHEN is_base THEN coverage = 1 ELSE coverage >= {op10.COVERED} AND high - low + 1 <= {op10.LONGER} * n_grams + {op10.SLIP} END AS accepted FROM spans),
    found AS (SELECT r, count(*) FILTER (accepted AND is_base) AS n_base, min(diagonal) FILTER (accepted AND is_base) AS first_word, max(diagonal) FILTER (accepted AND is_base) AS last_word,
        {named('accepted AND is_base')} AS base_labels, {named('accepted')} AS labels, max(coverage) AS score FROM judged GROUP BY r)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, CAST(coalesce(score, 0) AS DOUBLE) AS score
    FROM docs LEFT JOIN found USING (r)"""


#: A-Z lower-cased, and nothing else.
LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def shingle_links() -> str:
    k = op11.WORDS
    return rf"""WITH RECURSIVE docs AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({LOWERED}, '[^ 	-
]+') AS w FROM documents),
    sets AS MATERIALIZED (SELECT r, doc_id, list_sort(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {k} THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - {k - 2}), lambda i: array_to_string(w[i : i + {k - 1}], ' ')) END)) AS s FROM docs),
    classes AS MATERIALIZED (SELECT min(r) AS c, s, len(s) AS n FROM sets WHERE len(s) > 0 GROUP BY s),
    each AS MATERIALIZED (SELECT c, n, unnest(s) AS shingle FROM classes),
    links AS MATERIALIZED (SELECT x.c AS a, y.c AS b FROM each x JOIN each y ON x.shingle = y.shingle AND x.c <> y.c GROUP BY x.c, y.c, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))),
    reached(c, other) AS (SELECT c, c FROM classes UNION SELECT c, b FROM reached JOIN links ON a = other),
    least AS (SELECT c.s, min(o.doc_id) AS component_id FROM reached JOIN classes c ON c.c = reached.c JOIN classes d ON d.c = reached.other JOIN sets o ON o.s = d.s GROUP BY c.s)
    SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, CASE WHEN len(s) = 0 THEN doc_id ELSE component_id END AS component_id, doc_id IS NOT DISTINCT FROM CASE WHEN len(s) = 0 THEN doc_id ELSE component_id END AS kept
    FROM sets LEFT JOIN least USING (s)"""


def centroids() -> str:
    """Each round's assignment, then its means; sums and products stay below 2 ** 53, so that doubles are exact."""
    d, steps = op12.DIMS, []
    for r in range(op12.ROUNDS + 1):
        steps.append(f"""a{r} AS MATERIALIZED (SELECT vec_id, v, min_by(c, (distance, c)) AS cluster, min(distance) AS distance FROM (SELECT x.*, c, CAST(vv - 2 * list_dot_product(v, m) + list_dot_product(m, m) AS BIGINT) AS distance FROM vectors x, c{r}) GROUP BY n, vec_id, v)""")
        if r < op12.ROUNDS:
            steps.append(f"""c{r + 1} AS MATERIALIZED (SELECT c, coalesce(new.m, old.m) AS m FROM c{r} old LEFT JOIN (SELECT cluster AS c, list(mean ORDER BY i) AS m FROM (SELECT cluster, i, floor(sum(v[i]) / count(*)) AS mean FROM a{r}, range(1, {d + 1}) t(i) GROUP BY ALL) GROUP BY cluster) new USING (c))""")
    return f"""WITH vectors AS MATERIALIZED (SELECT row_number() OVER () AS n, vec_id, v, list_dot_product(v, v) AS vv FROM (SELECT vec_id, list_transform(embedding, lambda x: floor({op12.SCALE} * CAST(x AS DOUBLE))) AS v FROM embeddings WHERE len(embedding) = {d} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)),
    c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v AS m FROM (SELECT v, sha256('2:' || coalesce(CAST(vec_id AS VARCHAR), 'null')) AS h FROM vectors ORDER BY h, v LIMIT {op12.K})),
    {', '.join(steps)}
    SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia, CAST(sum(distance) OVER () AS BIGINT) AS inertia,
    sha256(array_to_string(list_transform(m, lambda x: CAST(CAST(x AS BIGINT) AS VARCHAR)), ',')) AS centroid_sha256 FROM a{op12.ROUNDS} JOIN c{op12.ROUNDS} ON c = cluster"""


def ranking() -> str:
    found = rf"regexp_extract_all({LOWERED}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
    return f"""WITH docs AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {found} AS w FROM documents),
    totals AS (SELECT count(*) AS docs, CAST(sum(len(w)) AS BIGINT) AS terms FROM docs WHERE len(w) > 0),
    tf AS MATERIALIZED (SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, len(w) AS n, unnest(w) AS term FROM docs) GROUP BY ALL),
    weights AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS weight FROM tf, totals GROUP BY term, docs),
    asked AS (SELECT DISTINCT item_id, unnest({found}) AS term FROM benchmark),
    scores AS (SELECT item_id, r, doc_id, CAST(sum(weight * (1000000000 * tf // (1000 * tf + 20 * (50 + 50 * n * docs // terms)))) AS BIGINT) AS score FROM asked JOIN weights USING (term) JOIN tf USING (term), totals GROUP BY item_id, r, doc_id)
    SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0) WHERE rank <= {op13.TOP}"""


ORACLES = {"op6_spaced_seeds": spaced_seeds(), "op10_diagonal": diagonal_voting(), "op11_multiindex": shingle_links(), "op12_centroids": centroids(), "op13_bitsliced": ranking()}
