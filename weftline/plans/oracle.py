"""DuckDB SQL for the named queries, written from the definitions and not from the Spark plans.

Doubles that rank rows are rounded to nine decimals first, as in the operators.
"""

from __future__ import annotations

from weftline.functions.wordlists import BATCH_ENTITY_LABELS, NEWS_STOP_WORDS, SEARCH_STOP_WORDS

ORACLE: dict[str, str] = {}


def sql_list(values) -> str:
    return ", ".join(f"'{value}'" for value in values)


WHITE = (
    r"\x{09}-\x{0d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
WORD = r"[\p{L}\p{N}_]+"

# --- search -----------------------------------------------------------------------------------------


def search_terms(text: str) -> str:
    return (
        f"list_filter(regexp_extract_all(lower({text}), '{WORD}'), "
        f"lambda w: regexp_full_match(w, '[a-z]+') AND w NOT IN ({sql_list(SEARCH_STOP_WORDS)}))"
    )


TF = f"""
tf AS MATERIALIZED (
  SELECT doc_id, term, count(*) AS tf
  FROM (SELECT doc_id, unnest({search_terms('text')}) AS term FROM documents)
  GROUP BY doc_id, term)"""
IDF = f"""{TF},
df AS MATERIALIZED (SELECT term, count(*) AS df FROM tf GROUP BY term),
idf AS MATERIALIZED (SELECT term, df, ln((SELECT count(*) FROM documents) / df) AS idf FROM df)"""
TFIDF = f"""{IDF},
w AS MATERIALIZED (SELECT doc_id, term, tf, tf * idf AS tfidf FROM tf JOIN idf USING (term)),
norms AS MATERIALIZED (SELECT doc_id, sqrt(sum(tfidf * tfidf)) AS norm FROM w GROUP BY doc_id)"""

PHRASES = "SELECT item_id::VARCHAR AS query_id, text FROM benchmark"
WORDS = f"SELECT DISTINCT term AS query_id, term AS text FROM (SELECT unnest({search_terms('text')}) AS term FROM benchmark)"


def search_ctes(asked: str) -> str:
    return f"""{TFIDF},
asked AS (SELECT query_id, {search_terms('text')} AS tokens FROM ({asked})),
single AS (
  SELECT query_id, doc_id, tfidf AS score
  FROM (SELECT query_id, tokens[1] AS term FROM asked WHERE len(tokens) = 1) JOIN w USING (term)),
weights AS MATERIALIZED (
  SELECT query_id, term, n * idf AS weight
  FROM (SELECT query_id, term, count(*) AS n
        FROM (SELECT query_id, unnest(tokens) AS term FROM asked WHERE len(tokens) > 1)
        GROUP BY query_id, term)
  JOIN idf USING (term)),
query_norms AS (SELECT query_id, sqrt(sum(weight * weight)) AS query_norm FROM weights GROUP BY query_id),
several AS (
  SELECT query_id, doc_id, dot / (query_norm * norm) AS score
  FROM (SELECT query_id, doc_id, sum(weight * tfidf) AS dot FROM weights JOIN w USING (term) GROUP BY query_id, doc_id)
  JOIN query_norms USING (query_id) JOIN norms USING (doc_id)
  WHERE query_norm > 0 AND norm > 0 AND dot > 0)"""


def ranked(scores: str) -> str:
    return f"""
SELECT * FROM (
  SELECT query_id, doc_id, score,
         row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, doc_id)::INTEGER AS rank
  FROM {scores})
WHERE rank <= 10"""


TITLES = "(SELECT page_id AS doc_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title FROM pages)"
COSINE = f"WITH {search_ctes(PHRASES)} SELECT query_id, doc_id, round(score, 6) AS score, rank FROM ({ranked('several')})"

ORACLE["tokens"] = f"""
SELECT doc_id, len(t)::INTEGER AS n_tokens, array_to_string(t, ' ') AS tokens
FROM (SELECT doc_id, {search_terms('text')} AS t FROM documents)"""
ORACLE["term_frequency"] = f"WITH {TF} SELECT * FROM tf"
ORACLE["document_frequency"] = f"WITH {IDF} SELECT * FROM df"
ORACLE["idf"] = f"WITH {IDF} SELECT term, df, round(idf, 6) AS idf FROM idf"
ORACLE["tfidf"] = f"WITH {TFIDF} SELECT doc_id, term, tf, round(tfidf, 6) AS tfidf FROM w"
ORACLE["doc_norms"] = f"WITH {TFIDF} SELECT doc_id, round(norm, 6) AS norm FROM norms"
ORACLE["doc_vectors"] = f"""
WITH {TFIDF} SELECT doc_id, count(*)::INTEGER AS n_terms, round(sum(tfidf), 4) AS total_weight FROM w GROUP BY doc_id"""
ORACLE["search_single_term"] = (
    f"WITH {search_ctes(WORDS)} SELECT query_id, doc_id, round(score, 6) AS score, rank FROM ({ranked('single')})"
)
ORACLE["search_cosine_topk"] = COSINE
ORACLE["search_saved_index"] = COSINE
ORACLE["search_blockmax_topk"] = COSINE
ORACLE["search_growing_index"] = COSINE.replace("FROM documents", "FROM (SELECT * FROM documents WHERE doc_id % 7 <> 0 OR doc_id % 14 = 0)")
ORACLE["search_with_titles"] = f"""
WITH {search_ctes(f'{PHRASES} UNION ALL {WORDS}')}
SELECT query_id, doc_id, round(score, 6) AS score, rank, coalesce(title, 'Unknown') AS title
FROM ({ranked('(SELECT * FROM single UNION ALL SELECT * FROM several)')}) LEFT JOIN {TITLES} USING (doc_id)"""
ORACLE["search_last_title"] = f"""
SELECT f.*, coalesce(title, 'Unknown') AS title FROM ({COSINE}) f LEFT JOIN {TITLES} USING (doc_id)"""
ORACLE["query_file"] = f"""
SELECT line AS query_id, t AS text
FROM (SELECT 2 * item_id + n AS line, regexp_replace(text, '^[{WHITE}]+|[{WHITE}]+$', '', 'g') AS t
      FROM benchmark, (SELECT unnest([0, 1]) AS n)) WHERE t <> ''"""

# --- entities ---------------------------------------------------------------------------------------


def capitalised(text: str) -> str:
    return f"list_filter(regexp_extract_all({text}, '{WORD}'), lambda w: regexp_full_match(w, '[A-Z][a-z]+'))"


ENTITIES = f"""
entities AS (
  SELECT entity, count(*) AS count FROM (SELECT unnest({capitalised('text')}) AS entity FROM documents) GROUP BY entity)"""

ORACLE["entity_counts_top20"] = f"WITH {ENTITIES} SELECT * FROM entities ORDER BY count DESC, entity LIMIT 20"
ORACLE["entity_counts_of_parts"] = ORACLE["entity_counts_top20"]
ORACLE["entity_counts_labelled"] = f"""
WITH {ENTITIES},
gazetteer AS (
  SELECT DISTINCT entity,
    CASE WHEN length(entity) <= 3 THEN 'PERSON' WHEN length(entity) <= 5 THEN 'GPE'
         WHEN length(entity) <= 7 THEN 'ORG' WHEN length(entity) <= 9 THEN 'LOC' ELSE 'EVENT' END AS label
  FROM (SELECT unnest({capitalised('text')}) AS entity FROM benchmark))
SELECT entity, label, count FROM entities JOIN gazetteer USING (entity) WHERE label IN ({sql_list(BATCH_ENTITY_LABELS)})"""
NAMES = f"""
RECURSIVE words AS (SELECT doc_id, regexp_extract_all(text, '{WORD}') AS w FROM documents),
asked AS (SELECT regexp_extract_all(text, '{WORD}') AS w FROM benchmark),
name_list AS (
  SELECT DISTINCT array_to_string(w[i + 1:i + 1 + i % 4], ' ') AS entity FROM (SELECT w, unnest(range(len(w))) AS i FROM asked)
  WHERE regexp_full_match(w[i + 1], '[A-Z][a-z]+')),
labelled AS (
  SELECT entity, CASE WHEN length(entity) <= 6 THEN 'PERSON' WHEN length(entity) <= 12 THEN 'GPE'
                      WHEN length(entity) <= 18 THEN 'ORG' ELSE 'EVENT' END AS label
  FROM name_list),
places AS (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS i FROM words),
ahead AS (
  SELECT doc_id, i, word AS r1, word || ' ' || lead(word, 1) OVER w AS r2,
    word || ' ' || lead(word, 1) OVER w || ' ' || lead(word, 2) OVER w AS r3,
    word || ' ' || lead(word, 1) OVER w || ' ' || lead(word, 2) OVER w || ' ' || lead(word, 3) OVER w AS r4
  FROM places WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
runs AS (
  SELECT doc_id, i, 1 AS k, r1 AS entity FROM ahead UNION ALL SELECT doc_id, i, 2, r2 FROM ahead
  UNION ALL SELECT doc_id, i, 3, r3 FROM ahead UNION ALL SELECT doc_id, i, 4, r4 FROM ahead),
best AS MATERIALIZED (
  SELECT doc_id, i AS place, max(k) AS n_words, arg_max(entity, k) AS entity, arg_max(label, k) AS label
  FROM runs JOIN labelled USING (entity) GROUP BY doc_id, i),
following AS MATERIALIZED (
  SELECT a.doc_id, a.place, b.place AS next
  FROM best a ASOF JOIN best b ON a.doc_id = b.doc_id AND a.place + a.n_words <= b.place),
walk AS (
  SELECT doc_id, min(place) AS place FROM best GROUP BY doc_id
  UNION ALL
  SELECT doc_id, next FROM walk JOIN following USING (doc_id, place)),
mentions AS (
  SELECT doc_id, place::INTEGER AS place, n_words::INTEGER AS n_words, entity, label FROM walk JOIN best USING (doc_id, place)
  WHERE label IN ({sql_list(BATCH_ENTITY_LABELS)}))"""
ORACLE["name_mentions"] = f"WITH {NAMES} SELECT * FROM mentions"
ORACLE["name_counts"] = f"WITH {NAMES} SELECT entity, label, count(*) AS count FROM mentions GROUP BY ALL"
ORACLE["entity_counts_model"] = f"""
WITH {ENTITIES} SELECT * FROM entities WHERE entity[-1] IN ('e', 'n', 'r', 's')
ORDER BY count DESC, entity LIMIT 20"""

# --- sampling and splitting -------------------------------------------------------------------------

MEMBERS = """
members AS MATERIALIZED (
  SELECT DISTINCT owner::VARCHAR AS owner, friend::VARCHAR AS friend FROM (
    SELECT l_partkey AS owner, l_suppkey AS friend FROM lineitem
    UNION ALL SELECT l_suppkey, l_partkey FROM lineitem))"""
USERS = f"""{MEMBERS},
users AS MATERIALIZED (SELECT "user" FROM (SELECT DISTINCT owner AS "user" FROM members) ORDER BY md5('42|' || "user"), "user" LIMIT 10)"""
IS_TEST = "substring(md5('42|' || doc_id), 1, 8) < '33333333'"

ORACLE["first_users"] = f"""
WITH {MEMBERS}, firsts AS (SELECT DISTINCT owner AS "user" FROM members ORDER BY owner::BIGINT LIMIT 1000)
SELECT "user", (row_number() OVER (ORDER BY "user"::BIGINT) - 1)::INTEGER AS position FROM firsts"""
ORACLE["user_positions"] = f"""
WITH {MEMBERS}
SELECT "user", row_number() OVER (ORDER BY "user"::BIGINT) AS position FROM (SELECT DISTINCT owner AS "user" FROM members)"""
ORACLE["sampled_users"] = f"WITH {USERS} SELECT * FROM users"
ORACLE["train_test_split"] = f"SELECT doc_id, {IS_TEST} AS is_test FROM documents"

# --- recommendations --------------------------------------------------------------------------------

EXISTING = f"""{USERS},
existing AS MATERIALIZED (
  SELECT DISTINCT least(owner, friend) AS a, greatest(owner, friend) AS b
  FROM members WHERE owner IN (SELECT "user" FROM users))"""
MUTUAL = f"""{EXISTING},
mutual AS MATERIALIZED (
  SELECT x.friend AS "user", y.friend AS candidate, count(*) AS mutual
  FROM members x JOIN members y ON x.owner = y.owner AND x.friend <> y.friend
  WHERE x.friend IN (SELECT "user" FROM users) GROUP BY x.friend, y.friend)"""
CANDIDATES = f"""{MUTUAL},
candidates AS (
  SELECT m.* FROM mutual m
  LEFT JOIN existing e ON e.a = least(m."user", m.candidate) AND e.b = greatest(m."user", m.candidate)
  WHERE e.a IS NULL)"""
RECOMMENDED = f"""{CANDIDATES},
recommended AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY "user" ORDER BY mutual DESC, candidate::BIGINT)::INTEGER AS rank FROM candidates)
  WHERE rank <= 10)"""
LINES = f"""
WITH {RECOMMENDED}
SELECT "user" || chr(9) || string_agg(candidate, ',' ORDER BY rank) AS value FROM recommended GROUP BY "user" """

ORACLE["existing_friendships"] = f"WITH {EXISTING} SELECT * FROM existing"
ORACLE["mutual_friend_counts"] = f"WITH {MUTUAL} SELECT * FROM mutual"
ORACLE["candidate_counts"] = f"WITH {CANDIDATES} SELECT * FROM candidates"
ORACLE["recommend_topk"] = f"WITH {RECOMMENDED} SELECT * FROM recommended"
ORACLE["recommend_all"] = ORACLE["recommend_topk"].replace("""ORDER BY md5('42|' || "user"), "user" LIMIT 10""", "")
ORACLE["recommend_lines"] = LINES
ORACLE["recommendation_file"] = LINES
ORACLE["recommend_from_lines"] = """
WITH lists AS MATERIALIZED (
  SELECT row_number() OVER () AS list_id, l_partkey::VARCHAR AS owner, l_suppkey::VARCHAR AS supp, l_linenumber::VARCHAR AS line
  FROM lineitem WHERE l_linenumber < 7),
entries AS MATERIALIZED (
  SELECT list_id, owner, friend, count(*) AS times FROM (
    SELECT list_id, owner, supp AS friend FROM lists UNION ALL SELECT list_id, owner, supp FROM lists
    UNION ALL SELECT list_id, owner, line FROM lists)
  GROUP BY list_id, owner, friend),
users AS MATERIALIZED (SELECT "user" FROM (SELECT DISTINCT friend AS "user" FROM entries) ORDER BY md5('42|' || "user"), "user" LIMIT 10),
existing AS MATERIALIZED (
  SELECT DISTINCT least(owner, friend) AS a, greatest(owner, friend) AS b
  FROM entries WHERE owner IN (SELECT "user" FROM users)),
mutual AS (
  SELECT x.friend AS "user", y.friend AS candidate, sum(x.times * y.times)::BIGINT AS mutual
  FROM entries x JOIN entries y ON x.list_id = y.list_id AND x.friend <> y.friend
  WHERE x.friend IN (SELECT "user" FROM users) GROUP BY x.friend, y.friend)
SELECT * FROM (
  SELECT m.*, row_number() OVER (PARTITION BY m."user" ORDER BY m.mutual DESC, m.candidate::BIGINT)::INTEGER AS rank
  FROM mutual m
  LEFT JOIN existing e ON e.a = least(m."user", m.candidate) AND e.b = greatest(m."user", m.candidate)
  WHERE e.a IS NULL)
WHERE rank <= 10"""

# --- classification ---------------------------------------------------------------------------------


def news(docs: str) -> str:
    """CTEs up to ``news(doc_id, label, tokens)``, step by step as the cleaning is defined."""
    return f"""
docs AS ({docs}),
text_lines AS (SELECT doc_id, label, text, string_split(text, chr(10)) AS lines FROM docs),
blanks AS (
  SELECT *, list_position(list_transform(lines[7:], lambda l: regexp_full_match(l, '[{WHITE}]*')), true) AS blank
  FROM text_lines),
bodies AS (
  SELECT doc_id, label,
         CASE WHEN coalesce(blank, 0) = 0 THEN text ELSE array_to_string(lines[blank + 6:], chr(10)) END AS body
  FROM blanks),
no_mail AS (SELECT doc_id, label, regexp_replace(body, '[^{WHITE}]+@[^{WHITE}]+', '', 'g') AS body FROM bodies),
no_url AS (SELECT doc_id, label, regexp_replace(body, 'http[^{WHITE}]+|www\\.[^{WHITE}]+', '', 'g') AS body FROM no_mail),
letters AS (SELECT doc_id, label, regexp_replace(lower(body), '[^a-z]', ' ', 'g') AS body FROM no_url),
news AS MATERIALIZED (
  SELECT * FROM (
    SELECT doc_id, label,
           list_filter(string_split(body, ' '), lambda t: length(t) > 2 AND t NOT IN ({sql_list(NEWS_STOP_WORDS)})) AS tokens
    FROM letters)
  WHERE len(tokens) > 5),
train AS MATERIALIZED (SELECT * FROM news WHERE NOT ({IS_TEST})),
test AS MATERIALIZED (SELECT * FROM news WHERE {IS_TEST}),
priors AS (SELECT label, count(*) AS n_docs, count(*) / (SELECT count(*) FROM train) AS prior FROM train GROUP BY label),
counts AS MATERIALIZED (
  SELECT label, word, count(*) AS n FROM (SELECT label, unnest(tokens) AS word FROM train) GROUP BY label, word),
totals AS (SELECT label, sum(len(tokens))::BIGINT AS n_words FROM train GROUP BY label)"""


def predicted(docs: str) -> str:
    """Every class scored for every test document, word by word."""
    return f"""{news(docs)},
classes AS MATERIALIZED (
  SELECT label AS predicted, ln(prior) AS log_prior, n_words + (SELECT count(DISTINCT word) FROM counts) AS below
  FROM priors JOIN totals USING (label)),
test_words AS MATERIALIZED (
  SELECT doc_id, word, count(*) AS times FROM (SELECT doc_id, unnest(tokens) AS word FROM test) GROUP BY doc_id, word),
scores AS (
  SELECT doc_id, predicted,
         any_value(log_prior) + sum(times * ln((coalesce(n, 0) + 1) / below)) AS score
  FROM test_words CROSS JOIN classes
  LEFT JOIN counts ON counts.label = predicted AND counts.word = test_words.word
  GROUP BY doc_id, predicted),
winners AS (
  SELECT doc_id, predicted, score FROM (
    SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY round(score, 9) DESC, predicted) AS place FROM scores)
  WHERE place = 1),
predictions AS (SELECT doc_id, label, predicted, score FROM test JOIN winners USING (doc_id))"""


BY_LANGUAGE = "SELECT doc_id, lang AS label, text FROM documents"
BY_QUALITY = "SELECT doc_id, quality::VARCHAR AS label, text FROM documents JOIN labels USING (doc_id)"
NEWS = news(BY_LANGUAGE)
PREDICTED = predicted(BY_LANGUAGE)

ORACLE["news_tokens"] = (
    f"WITH {NEWS} SELECT doc_id, len(tokens)::INTEGER AS n_tokens, array_to_string(tokens, ' ') AS tokens FROM news"
)
ORACLE["split_sizes"] = f"""
WITH {NEWS} SELECT CASE WHEN {IS_TEST} THEN 'test' ELSE 'train' END AS part, count(*) AS n_docs FROM news GROUP BY 1"""
ORACLE["class_priors"] = f"WITH {NEWS} SELECT label, n_docs, round(prior, 6) AS prior FROM priors"
ORACLE["largest_priors"] = f"{ORACLE['class_priors']} ORDER BY prior DESC, label LIMIT 10"
ORACLE["word_class_counts"] = f"WITH {NEWS} SELECT * FROM counts"
ORACLE["class_word_totals"] = f"WITH {NEWS} SELECT * FROM totals"
ORACLE["vocabulary_size"] = f"""
WITH {NEWS} SELECT count(DISTINCT word) AS n_vocabulary, sum(n)::BIGINT AS n_words FROM counts"""
ORACLE["vocabulary_sketches"] = f"SELECT n_vocabulary, true AS near FROM ({ORACLE['vocabulary_size']})"
ORACLE["nb_predict"] = f"WITH {PREDICTED} SELECT doc_id, label, predicted, round(score, 4) AS score FROM predictions"
ORACLE["nb_quality_predict"] = f"""
WITH {predicted(BY_QUALITY)} SELECT doc_id, label, predicted, round(score, 4) AS score FROM predictions"""
ORACLE["nb_accuracy"] = f"""
WITH {PREDICTED}
SELECT count(*) AS n_test, count(*) FILTER (label = predicted) AS n_correct,
       round(avg((label = predicted)::INTEGER), 6) AS accuracy
FROM predictions"""
ORACLE["nb_class_accuracy"] = f"""
WITH {PREDICTED}
SELECT label, count(*) FILTER (label = predicted) AS n_correct, count(*) AS n_test,
       round(avg((label = predicted)::INTEGER), 6) AS accuracy
FROM predictions GROUP BY label ORDER BY accuracy DESC, label LIMIT 10"""

# --- graph ------------------------------------------------------------------------------------------

SUPPLY = """
edges AS MATERIALIZED (SELECT l_partkey AS src, l_suppkey AS dst FROM lineitem),
vertices AS MATERIALIZED (SELECT src AS id FROM edges UNION SELECT dst FROM edges)"""
ORDERS = SUPPLY.replace("l_partkey", "o_orderkey").replace("l_suppkey", "o_custkey").replace("lineitem", "orders")


def pagerank_rounds(n: int) -> str:
    rounds = ["r0 AS MATERIALIZED (SELECT id, 1.0::DOUBLE AS rank FROM vertices)"]
    for i in range(1, n + 1):
        rounds.append(f"""
r{i} AS MATERIALIZED (
  SELECT v.id, 0.15 + 0.85 * coalesce(sum(r.rank / d.degree), 0) AS rank
  FROM vertices v LEFT JOIN edges e ON e.dst = v.id
  LEFT JOIN r{i - 1} r ON r.id = e.src LEFT JOIN degrees d ON d.id = e.src
  GROUP BY v.id)""")
    return ", ".join(rounds)


PAGERANK = f"""
WITH {SUPPLY},
degrees AS MATERIALIZED (SELECT src AS id, count(*) AS degree FROM edges GROUP BY src),
{pagerank_rounds(10)}
SELECT id, round(rank * (SELECT count(*) / sum(rank) FROM r10), 6) AS pagerank FROM r10"""

COMPONENTS = f"""
WITH RECURSIVE {ORDERS},
both_ways AS MATERIALIZED (SELECT src AS a, dst AS b FROM edges UNION SELECT dst, src FROM edges),
cc(id, component) USING KEY (id) AS (
  SELECT id, id FROM vertices
  UNION
  (SELECT e.b AS id, min(c.component) AS component
   FROM cc c JOIN both_ways e ON e.a = c.id JOIN recurring.cc old ON old.id = e.b
   WHERE c.component < old.component GROUP BY e.b))
SELECT id, component FROM cc"""
COMPONENT_SIZES = f"SELECT component, count(*) AS count FROM ({COMPONENTS}) GROUP BY component"

TRIANGLES = f"""
WITH {SUPPLY},
pairs AS MATERIALIZED (SELECT DISTINCT least(src, dst) AS a, greatest(src, dst) AS b FROM edges WHERE src <> dst),
triangles AS MATERIALIZED (
  SELECT x.a AS a, x.b AS b, y.b AS c
  FROM pairs x JOIN pairs y ON x.b = y.a JOIN pairs z ON z.a = x.a AND z.b = y.b),
corners AS (SELECT a AS id FROM triangles UNION ALL SELECT b FROM triangles UNION ALL SELECT c FROM triangles)
SELECT id, count(corners.id) AS count FROM vertices LEFT JOIN corners USING (id) GROUP BY id"""

OUT_DEGREES = "SELECT l_partkey AS id, count(*) AS out_degree FROM lineitem GROUP BY l_partkey"
IN_DEGREES = "SELECT l_suppkey AS id, count(*) AS in_degree FROM lineitem GROUP BY l_suppkey"

ORACLE["graph_vertices"] = f"WITH {SUPPLY} SELECT id FROM vertices"
ORACLE["graph_size"] = f"""
WITH {SUPPLY} SELECT (SELECT count(*) FROM edges) AS n_edges, (SELECT count(*) FROM vertices) AS n_vertices"""
ORACLE["out_degrees"] = OUT_DEGREES
ORACLE["in_degrees"] = IN_DEGREES
ORACLE["out_degree_top5"] = f"{OUT_DEGREES} ORDER BY out_degree DESC, id LIMIT 5"
ORACLE["in_degree_top5"] = f"{IN_DEGREES} ORDER BY in_degree DESC, id LIMIT 5"
ORACLE["csv_out_degrees"] = OUT_DEGREES
ORACLE["pagerank"] = PAGERANK
ORACLE["pagerank_top5"] = f"{PAGERANK} ORDER BY pagerank DESC, id LIMIT 5"
ORACLE["components"] = COMPONENTS
ORACLE["components_growing"] = COMPONENTS
ORACLE["component_sizes"] = COMPONENT_SIZES
ORACLE["component_sizes_top5"] = f"{COMPONENT_SIZES} ORDER BY count DESC, component LIMIT 5"
ORACLE["triangle_counts"] = TRIANGLES
ORACLE["triangles_top5"] = f"SELECT * FROM ({TRIANGLES}) ORDER BY count DESC, id LIMIT 5"

# --- line formats -----------------------------------------------------------------------------------

ORACLE["parse_id_text"] = """
SELECT doc_id::VARCHAR AS doc_id, source || chr(9) || text AS text FROM documents WHERE lang <> 'fr'
UNION ALL
SELECT split_part(text, chr(9), 1), substring(text, strpos(text, chr(9)) + 1) FROM documents
WHERE lang = 'fr' AND strpos(text, chr(9)) > 0"""
ORACLE["parse_titles"] = "SELECT p_partkey::VARCHAR AS doc_id, p_name AS title FROM part WHERE p_size > 3"
ORACLE["parse_adjacency"] = """
SELECT l_partkey::VARCHAR AS "user", l_suppkey || '|' || l_linenumber || '|' || l_suppkey AS friends
FROM lineitem WHERE l_linenumber < 7"""
ORACLE["parse_edges"] = """
SELECT CASE WHEN l_linenumber = 4 THEN '' ELSE l_partkey::VARCHAR END AS src,
       CASE WHEN l_linenumber = 4 THEN l_partkey ELSE l_suppkey END::VARCHAR AS dst
FROM lineitem WHERE l_linenumber > 3"""

# --- messages and streams ---------------------------------------------------------------------------

ORACLE["json_decode"] = "SELECT (props::JSON->>'k')::BIGINT AS k, count(*) AS n FROM events GROUP BY 1"
ORACLE["message_round_trip"] = """
SELECT doc_id::VARCHAR AS id, source AS author, 0.5::DOUBLE AS created_utc, text, lang AS subreddit FROM documents"""
ORACLE["messages_accepted"] = ORACLE["message_round_trip"] + " WHERE doc_id % 7 > 2"
ORACLE["messages_rejected"] = """
SELECT CASE doc_id % 7 WHEN 0 THEN 'no JSON' WHEN 1 THEN 'no object' ELSE 'type of created_utc' END AS reason, count(*) AS n
FROM documents WHERE doc_id % 7 <= 2 GROUP BY 1"""
ORACLE["json_encode"] = f"""
WITH {ENTITIES} SELECT entity AS key, to_json({{'entity': entity, 'count': count}})::VARCHAR AS value FROM entities"""
ORACLE["index_records"] = f"WITH {ENTITIES} SELECT entity AS entity_name, count AS entity_count FROM entities"
ORACLE["normalise_headlines"] = f"""
SELECT url AS id, regexp_extract(url, '^[a-z]+://([^/]+)', 1) AS author, 0.5::DOUBLE AS created_utc, text, 'newsapi' AS subreddit
FROM (
  SELECT url, regexp_replace(regexp_extract(html, '<title>([^<]*)</title>', 1) || '. ' ||
                             regexp_extract(html, '<h1>([^<]*)</h1>', 1), '^[{WHITE}]+|[{WHITE}]+$', '', 'g') AS text
  FROM pages)
WHERE length(text) >= 10"""
ORACLE["stream_entity_counts"] = f"WITH {ENTITIES} SELECT * FROM entities"
ORACLE["stream_in_batches"] = f"WITH {ENTITIES} SELECT entity, 2 * count AS count FROM entities"
ORACLE["stream_counts_once"] = ORACLE["stream_entity_counts"]
ORACLE["stream_accepted_ids"] = "SELECT doc_id::VARCHAR AS id, 1700000000 + doc_id % 600 AS seconds FROM documents"
ORACLE["timed_count_messages"] = f"""
WITH {ENTITIES} SELECT entity AS entity_name, count AS entity_count, '2024-01-02 03:04:05' AS ts FROM entities"""
ORACLE["search_hot_terms"] = ORACLE["tfidf"]
ORACLE["labelled_folders"] = """
SELECT 'lang=' || coalesce(lang, '__HIVE_DEFAULT_PARTITION__') AS label, md5(text || chr(12)) AS text
FROM documents WHERE length(text) >= 50"""
ORACLE["labelled_two_folders"] = """
SELECT CASE doc_id % 2 WHEN 1 THEN 'train' ELSE 'test' END AS root, 'lang=' || coalesce(lang, '__HIVE_DEFAULT_PARTITION__') AS label,
    md5(text || chr(12)) AS text
FROM documents WHERE length(text) >= 50"""
ORACLE["stream_two_queries"] = f"""
WITH {ENTITIES} SELECT entity, count, unnest(['first', 'second']) AS sink FROM entities"""
ORACLE["clock_columns"] = f"""
WITH {ENTITIES}
SELECT 'count' AS kind, true AS fresh, count(*) AS n FROM entities
UNION ALL SELECT 'headline', true, count(*) FROM ({ORACLE["normalise_headlines"]})"""
