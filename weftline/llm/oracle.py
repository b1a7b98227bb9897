"""DuckDB SQL with the same rows as the queries that SQL can express."""

from __future__ import annotations

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP1 = rf"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text, {WORDS} AS w FROM documents),
pieces AS (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line FROM d),
lines AS (
    SELECT *, regexp_extract_all(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS lw
    FROM pieces),
full_lines AS (SELECT doc_id, source, line, array_to_string(lw, ' ') AS norm, len(lw) AS n FROM lines WHERE len(lw) > 0),
dups AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM full_lines GROUP BY doc_id),
hosts AS (SELECT source, count(DISTINCT doc_id) AS host_docs FROM d GROUP BY source),
common AS (
    SELECT f.source, norm FROM full_lines f JOIN hosts h ON f.source IS NOT DISTINCT FROM h.source
    GROUP BY f.source, norm, host_docs
    HAVING count(DISTINCT doc_id) > 20 AND count(DISTINCT doc_id) > host_docs * 0.02),
gone AS (
    SELECT doc_id, sum(n)::BIGINT AS n_common_words FROM full_lines f
    JOIN common c ON f.norm = c.norm AND f.source IS NOT DISTINCT FROM c.source GROUP BY doc_id),
triples AS (
    SELECT doc_id, i, w[i:i + 2] AS t FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
often AS (
    SELECT doc_id, unnest([i, i + 1, i + 2]) AS p
    FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, t) AS n FROM triples) WHERE n > 1),
repeats AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words FROM often GROUP BY doc_id),
counts AS (
    SELECT d.doc_id, len(w)::BIGINT AS n_words,
        coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
        coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
        coalesce(n_common_words, 0)::BIGINT AS n_common_words
    FROM d LEFT JOIN dups USING (doc_id) LEFT JOIN repeats USING (doc_id) LEFT JOIN gone USING (doc_id))
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND n_words - n_common_words >= n_words * 0.5 AS kept
FROM counts
"""

OP8 = rf"""
WITH d AS (SELECT doc_id, {WORDS} AS w FROM documents),
windows AS (
    SELECT doc_id, i, array_to_string(w[i:i + 49], ' ') AS win
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)),
late AS (
    SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY win) AS first_id FROM windows)
    WHERE first_id < doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM late),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (
    SELECT words.doc_id, string_agg(word, ' ' ORDER BY words.p) AS kept, count(*) AS n
    FROM words ANTI JOIN gone ON words.doc_id = gone.doc_id AND words.p = gone.p GROUP BY words.doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
    sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

OP9 = rf"""
WITH RECURSIVE docs AS (
    SELECT doc_id, source, len({WORDS})::BIGINT AS size, md5('42|' || doc_id) AS key FROM documents),
sums AS (SELECT source, sum(size)::BIGINT AS source_size, count(*) AS n_docs FROM docs GROUP BY source),
ranked AS (
    SELECT *, [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight,
        row_number() OVER (ORDER BY source NULLS LAST) AS source_no
    FROM sums),
levels AS (
    SELECT 0 AS n, 0.0::DOUBLE AS level
    UNION ALL
    SELECT n + 1, (SELECT (1.5::DOUBLE * sum(source_size)
            - coalesce(sum(2.0::DOUBLE * source_size) FILTER (weight * l.level > 2.0::DOUBLE * source_size), 0))
            / sum(weight) FILTER (weight * l.level <= 2.0::DOUBLE * source_size) FROM ranked)
    FROM levels l WHERE n < (SELECT count(*) + 1 FROM ranked)),
targets AS (
    SELECT ranked.*, least(weight * (SELECT max(level) FROM levels), 2.0::DOUBLE * source_size) AS target FROM ranked),
total AS (SELECT least(65536, greatest(1, ceil(sum(target) / 100000)))::BIGINT AS common FROM targets),
blocks AS (
    SELECT *, least(common, greatest(1, floor(target / (ceil(n_docs / 8000.0) * 32))))::BIGINT AS block
    FROM targets, total),
pools AS (
    SELECT *, CASE WHEN block = common THEN 0 ELSE source_no END AS pool,
        CASE WHEN block = common THEN floor(sum(target) OVER (PARTITION BY block = common) / block + 0.5)
            ELSE floor(target / block + 0.5) END AS seats
    FROM blocks),
dealt AS (
    SELECT docs.*, source_no, source_size, target, block, pool, seats,
        ('0x' || substr(key, 1, 8))::BIGINT % ceil(n_docs / 8000.0)::BIGINT AS shard
    FROM docs JOIN pools ON docs.source IS NOT DISTINCT FROM pools.source),
shards AS (
    SELECT source_no, shard, block, pool, seats, sum(size)::BIGINT AS shard_size,
        CASE WHEN any_value(source_size) > 0 THEN any_value(target) * sum(size) / any_value(source_size) ELSE 0 END AS votes
    FROM dealt GROUP BY ALL),
bids AS (
    SELECT source_no, shard, pool, seats, votes, unnest(range(0, ceil(2.0 * shard_size / block)::BIGINT)) AS k FROM shards),
won AS (
    SELECT source_no, shard, count(*) AS quota FROM (
        SELECT *, row_number() OVER (PARTITION BY pool ORDER BY votes / (2 * k + 1) DESC, source_no, shard, k) AS place
        FROM bids)
    WHERE place <= seats GROUP BY source_no, shard),
laid AS (
    SELECT dealt.*, shard_size, least(coalesce(quota, 0) * dealt.block, 2 * shard_size)::BIGINT AS words,
        sum(size) OVER (PARTITION BY dealt.source_no, dealt.shard ORDER BY key, size)::BIGINT AS stop_at,
        ('0x' || substr(md5('42|' || coalesce(source, 'null') || '|' || dealt.shard), 1, 8))::BIGINT AS draw
    FROM dealt JOIN (SELECT source_no, shard, shard_size FROM shards) USING (source_no, shard) LEFT JOIN won USING (source_no, shard)),
placed AS (
    SELECT *, CASE WHEN shard_size > 0 THEN words // shard_size ELSE 0 END AS rounds,
        CASE WHEN shard_size > 0 THEN words % shard_size ELSE 0 END AS rest,
        CASE WHEN shard_size > 0 THEN draw % shard_size - (draw % shard_size) % block ELSE 0 END AS place
    FROM laid)
SELECT doc_id, size, source_size, round(target, 6) AS target,
    (rounds * size
        + greatest(0, least(place + rest, stop_at) - greatest(place, stop_at - size))
        + greatest(0, least(place + rest - shard_size, stop_at) - (stop_at - size)))::BIGINT AS taken
FROM placed
"""



def _way(state: str, cost: str, edits: str, out: str) -> str:
    """One more step on the path of a state: its cost, its edits and what it writes."""
    return (
        f"CASE WHEN {state} IS NOT NULL THEN "
        f"struct_pack(c := {state}.c + {cost}, a := {state}.a || {edits}, o := {state}.o || {out}) END"
    )


def _best(*ways: str) -> str:
    return f"list_sort(list_filter([{', '.join(ways)}], lambda w: w IS NOT NULL))[1]"


_NEW_USER, _NEW_ASSISTANT = "chr(10) || 'user:'", "chr(10) || 'assistant:'"
_CHANGED = "CASE WHEN initial = {0} THEN 0 ELSE 2 END + late"
_EDIT = "CASE WHEN initial = {0} THEN 'K' ELSE 'R' END"
_OUT = "chr(10) || CASE WHEN initial = {0} THEN role ELSE {1} END || ':' || text"


def _said(state: str, initial: str, role: str) -> str:
    """Keep or Rerole as ``role``, where the turn may stay."""
    way = _way(state, _CHANGED.format(initial), _EDIT.format(initial), _OUT.format(initial, role))
    return f"CASE WHEN NOT forced THEN {way} END"


#: crc32 goes over the bytes of the id and turn, each followed by eight shifts.
OP11 = rf"""
WITH RECURSIVE shown AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, xor(4294967295, list_reduce(
            list_prepend(4294967295::BIGINT, flatten(list_transform(
                string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''),
                lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
            lambda crc, b: CASE WHEN b >= 0 THEN xor(crc, b) ELSE xor(crc >> 1, 3988292384 * (crc & 1)) END)) % 20 AS kind
    FROM conversations),
damaged AS (
    SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
        CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
        unnest(range(CASE kind WHEN 3 THEN 2 ELSE 1 END)) AS copy
    FROM shown WHERE kind <> 0),
judged AS (
    SELECT *, CASE WHEN NOT regexp_matches(text, '[^ 	-
]') THEN 'blank'
            WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 THEN 'duplicate'
            WHEN NOT regexp_matches(text, '[.!?][ 	-
]*$') THEN 'truncated' ELSE '' END AS fault
    FROM damaged),
convs AS (SELECT conv_id, row_number() OVER () AS conv FROM (SELECT DISTINCT conv_id FROM conversations)),
turns AS (
    SELECT conv, turn, role, text, fault, left(role, 1) AS initial, fault IN ('blank', 'duplicate') AS forced,
        (fault = 'truncated')::INT AS late,
        row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, text, copy) AS seq
    FROM judged JOIN convs ON judged.conv_id IS NOT DISTINCT FROM convs.conv_id),
paths AS (
    SELECT conv, 0::BIGINT AS seq, struct_pack(c := 0, a := '', o := '') AS s0,
        NULL::STRUCT(c INT, a VARCHAR, o VARCHAR) AS s1, NULL::STRUCT(c INT, a VARCHAR, o VARCHAR) AS s2,
        NULL::STRUCT(c INT, a VARCHAR, o VARCHAR) AS s3
    FROM convs
    UNION ALL
    SELECT conv, seq, {_way("s0", "3", "'D'", "''")},
        {_best(_way("s1", "3", "'D'", "''"), "CASE WHEN initial = 's' THEN " + _said("s0", "'s'", "role") + " END")},
        {_best(_way("t2", "3", "'D'", "''"), _said("s0", "'u'", "'user'"), _said("s1", "'u'", "'user'"), _said("t3", "'u'", "'user'"))},
        {_best(_way("t3", "3", "'D'", "''"), _said("t2", "'a'", "'assistant'"))}
    FROM (
        SELECT p.conv, t.seq, t.role, t.text, t.initial, t.forced, t.late, s0, s1,
            {_best("s2", *(_way(s, "2", "'I'", _NEW_USER) for s in ("s0", "s1", "s3")))} AS t2,
            {_best("s3", _way("s2", "2", "'I'", _NEW_ASSISTANT),
                   *(_way(s, "4", "'II'", _NEW_USER + " || " + _NEW_ASSISTANT) for s in ("s0", "s1")))} AS t3
        FROM paths p JOIN turns t ON p.conv = t.conv AND p.seq + 1 = t.seq)),
ends AS (
    SELECT conv, {_best("s0", "s3", _way("s2", "2", "'I'", _NEW_ASSISTANT),
                        _way("s1", "4", "'II'", _NEW_USER + " || " + _NEW_ASSISTANT))} AS best
    FROM paths p WHERE seq = (SELECT count(*) FROM turns t WHERE t.conv = p.conv)),
counts AS (
    SELECT conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
        count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
        count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
    FROM (SELECT *, lag(initial) OVER (PARTITION BY conv ORDER BY seq) || initial AS pair FROM turns) GROUP BY conv)
SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
    coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
    coalesce(illegal, 0)::BIGINT AS illegal, best.c::BIGINT AS cost, best.a AS audit,
    sha256(substr(best.o, 2)) AS repaired_sha256
FROM convs JOIN ends USING (conv) LEFT JOIN counts USING (conv)
"""

ORACLE = {"op1_line_rules": OP1, "op8_repeated_passages": OP8, "op9_mixing": OP9, "op11_conversation_repair": OP11}
