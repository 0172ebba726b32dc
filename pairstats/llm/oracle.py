"""The same results in plain SQL, written for DuckDB, for the queries that SQL can express."""

from __future__ import annotations

from pairstats.llm import phrases, secrets
from pairstats.llm import quality_rules as rules

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

WORDS = r"""
words AS (
  SELECT doc_id, text,
         list_filter(regexp_split_to_array({text}, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents))"""

COMPONENTS = """
either AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(id, c) AS (
  SELECT a, a FROM either
  UNION
  SELECT either.b, reach.c FROM reach JOIN either ON either.a = reach.id),
component AS (SELECT id, min(c) AS c FROM reach GROUP BY id)"""


def _near_duplicates() -> str:
    lower = f"translate(text, '{UPPER}', '{LOWER}')"
    return f"""WITH RECURSIVE {WORDS.format(text=lower)},
      sets AS (
        SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN []
          WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
          ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))
          END) AS s
        FROM words),
      items AS (SELECT doc_id, len(s) AS n, unnest(s) AS s FROM sets),
      links AS (
        SELECT x.doc_id AS a, y.doc_id AS b
        FROM items x JOIN items y ON x.s = y.s AND x.doc_id < y.doc_id
        GROUP BY x.doc_id, y.doc_id, x.n, y.n
        HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))),{COMPONENTS}
      SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, coalesce(c, doc_id) AS component_id,
             coalesce(c, doc_id) = doc_id AS kept
      FROM sets LEFT JOIN component ON id = doc_id"""


def _near_vectors() -> str:
    return f"""WITH RECURSIVE v AS (
        SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
        WHERE embedding IS NOT NULL AND len(embedding) > 0
          AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
      u AS (SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS n FROM v
            WHERE list_dot_product(e, e) > 0),
      links AS (
        SELECT x.vec_id AS a, y.vec_id AS b FROM u x JOIN u y ON x.vec_id < y.vec_id
        WHERE len(x.e) = len(y.e) AND list_dot_product(x.e, y.e) / (x.n * y.n) >= 0.9),{COMPONENTS}
      SELECT vec_id, CAST((SELECT count(*) FROM either WHERE a = vec_id) AS BIGINT) AS n_links,
             coalesce(c, vec_id) AS component_id, coalesce(c, vec_id) = vec_id AS kept
      FROM embeddings LEFT JOIN component ON id = vec_id"""


def _quality_rules() -> str:
    names = list(rules.RULES)
    values = {
        "symbols_per_word": "n_symbols / n_words",
        "upper_share": "n_upper / word_chars",
        "dup_line_share": "n_dup_lines / n_lines",
        "repeat_word_share": "n_repeat_words / n_words",
        "bar_share": "n_bars / n_words",
        "bang_share": "n_bangs / n_words",
    }
    each = " UNION ALL ".join(
        f"SELECT doc_id, stratum, {k} AS rule, {rules.RULES[r]}::DOUBLE AS step, "
        f"coalesce({values[r]}, 0.0) AS value FROM facts WHERE NOT base_failed"
        for k, r in enumerate(names)
    )
    stratum = " ".join(
        f"WHEN n_words >= {least} THEN {k}" for k, least in reversed(list(enumerate(rules.STRATA)))
    )
    rate = rules.RISK / len(names)
    level = rules.DELTA / (len(rules.STRATA) * len(names))
    symbols = "".join("\\" + c for c in rules.SYMBOLS)
    return rf"""WITH {WORDS.format(text="text")},
      windows AS (
        SELECT doc_id, unnest(list_transform(range(1, len(w) - 1),
          lambda i: {{'i': i, 'a': w[i], 'b': w[i + 1], 'c': w[i + 2]}})) AS x
        FROM words WHERE len(w) > 2),
      counted AS (
        SELECT doc_id, x.i AS i, count(*) OVER (PARTITION BY doc_id, x.a, x.b, x.c) AS times
        FROM windows),
      repeated AS (
        SELECT doc_id, count(DISTINCT i + k) AS n
        FROM counted, (VALUES (0), (1), (2)) AS o(k) WHERE times > 1 GROUP BY doc_id),
      lined AS (
        SELECT doc_id, list_filter(string_split(text, chr(10)),
          lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS x
        FROM words),
      plain AS (
        SELECT doc_id, len(w) AS n_words, coalesce(n, 0) AS n_repeat_words, len(x) AS n_lines,
               len(x) - len(list_distinct(x)) AS n_dup_lines,
               length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
               length(text) - length(regexp_replace(text, '[{symbols}]', '', 'g')) AS n_symbols,
               length(text) - length(regexp_replace(text, '[A-Z]{{2,}}', '', 'g')) AS n_upper,
               length(text) - length(replace(text, '|', '')) AS n_bars,
               length(text) - length(replace(text, '!', '')) AS n_bangs
        FROM words JOIN lined USING (doc_id) LEFT JOIN repeated USING (doc_id)),
      facts AS (
        SELECT *, n_words < {rules.MIN_WORDS}
            OR 100 * n_repeat_words > {rules.MAX_REPEAT_PERCENT} * n_words AS base_failed,
          CASE {stratum} END AS stratum
        FROM plain),
      measured AS ({each}),
      good AS (
        SELECT doc_id, max(quality) AS label FROM labels WHERE quality IN (0, 1) GROUP BY doc_id),
      above AS (
        SELECT stratum, rule, step, label, greatest(0, least({rules.CUTOFFS},
                 CAST(ceil(value / step) AS INTEGER) - 1)) AS above
        FROM measured JOIN good USING (doc_id)),
      tested AS (
        SELECT stratum, rule, step, cutoff, sum(label) AS all_good, sum(1 - label) AS all_bad,
               sum(label) FILTER (above >= cutoff) AS good,
               sum(1 - label) FILTER (above >= cutoff) AS bad
        FROM above, range(1, {rules.CUTOFFS + 1}) AS r(cutoff) GROUP BY ALL),
      tails AS (
        SELECT stratum, rule, step, cutoff, all_good, all_bad, coalesce(good, 0) AS good,
               coalesce(bad, 0) AS bad
        FROM tested),
      passed AS (
        SELECT *, CASE WHEN good < all_good * {rate} THEN list_sum(list_transform(
            range(0, CAST(good AS BIGINT) + 1), lambda k: exp(lgamma(all_good + 1) - lgamma(k + 1)
              - lgamma(all_good - k + 1) + k * ln({rate}) + (all_good - k) * ln(1 - {rate}))))
            ELSE 1.0 END <= {level} AS passed
        FROM tails),
      certified AS (
        SELECT *, bool_and(passed) OVER (PARTITION BY stratum, rule ORDER BY cutoff DESC) AS ok,
               round(coalesce(bad / nullif(all_bad, 0), 0.0)
                     - {rules.GOOD_WEIGHT} * coalesce(good / nullif(all_good, 0), 0.0), 9) AS trade
        FROM passed),
      best AS (
        SELECT stratum, rule, cutoff * step AS cutoff FROM certified WHERE ok AND trade > 0
        QUALIFY row_number() OVER (
          PARTITION BY stratum, rule ORDER BY trade DESC, cutoff DESC) = 1),
      failed AS (
        SELECT DISTINCT doc_id FROM measured JOIN best USING (stratum, rule)
        WHERE value > best.cutoff)
      SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
             CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
             CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
             NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM failed) AS kept
      FROM facts"""


def _conversation_trie() -> str:
    # The CRC-32 of a decimal, bit by bit.
    crc = """xor(list_reduce(
          list_prepend(4294967295::BIGINT,
            list_transform(range(1, length(c::VARCHAR) + 1), lambda i: ascii((c::VARCHAR)[i])::BIGINT)),
          lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)),
            lambda x, r: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384::BIGINT ELSE 0 END))),
        4294967295::BIGINT)"""
    return f"""WITH turns AS (
        SELECT conv_id, strlen(text) AS bytes, digest,
               row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, digest) AS place
        FROM (SELECT conv_id, turn, coalesce(text, '') AS text,
                     sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))
                       AS digest
              FROM conversations WHERE conv_id IS NOT NULL)),
      sizes AS (SELECT conv_id AS c, count(*) AS n FROM turns GROUP BY conv_id),
      convs AS (SELECT c, c - c % 5 AS base, {crc} % 9 AS h FROM sizes),
      taken AS (SELECT convs.c, base, h, least(h, coalesce(n, 0)) AS t
                FROM convs LEFT JOIN sizes ON sizes.c = base),
      rebuilt AS (
        SELECT c, place AS depth, digest, bytes FROM taken JOIN turns ON conv_id = base AND place <= h
        UNION ALL
        SELECT c, t + place - h, digest, bytes FROM taken JOIN turns ON conv_id = c AND place > h),
      members AS (
        SELECT c, depth, bytes,
               string_agg(digest, '') OVER (PARTITION BY c ORDER BY depth) AS node
        FROM rebuilt
        UNION ALL SELECT c, 0, 0, '' FROM convs),
      whole AS (SELECT c, max_by(node, depth) AS node FROM members GROUP BY c),
      nodes AS (SELECT node, min(c) AS c, any_value(depth) AS depth, any_value(bytes) AS bytes,
                       count(*) AS n FROM members GROUP BY node),
      children AS (SELECT left(node, length(node) - 64) AS node, count(*) AS n
                   FROM nodes WHERE node <> '' GROUP BY 1),
      placed AS (SELECT nodes.*, coalesce(children.n, 0) AS k FROM nodes LEFT JOIN children USING (node)),
      under AS (SELECT u.node, count(*) FILTER (v.k = 0) AS leaves, sum((v.n - 1) * v.bytes) AS saved
                FROM placed u JOIN placed v ON starts_with(v.node, u.node) GROUP BY u.node),
      ends AS (SELECT node, string_agg(c::VARCHAR, ',' ORDER BY c) AS ids FROM whole GROUP BY node)
      SELECT p.c::BIGINT AS conv_id, p.depth::BIGINT AS depth, up.c::BIGINT AS parent_conv_id,
             p.n::BIGINT AS n_convs, p.k::BIGINT AS n_children, leaves::BIGINT AS n_leaves,
             saved::BIGINT AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
      FROM placed p JOIN under USING (node) LEFT JOIN ends USING (node)
      LEFT JOIN placed up ON p.node <> '' AND up.node = left(p.node, length(p.node) - 64)"""


def _secret_ownership() -> str:
    kinds = [
        (0, secrets.ASSIGN, 1, f"length(value) >= {secrets.LEAST['assign']}"),
        (1, secrets.ACCESS, 0, f"length(value) >= {secrets.LEAST['access']}"),
        (2, secrets.HEX, 0, f"length(value) >= {secrets.LEAST['hex']}"),
        (3, secrets.RUN, 0,
         f"length(value) <= {secrets.RUN_MOST} AND digits >= {secrets.RUN_DIGITS}"
         f" AND digits < length(value) AND distinct_chars >= {secrets.RUN_DISTINCT}"),
    ]

    def found(kind: int, pattern: str, group: int, keep: str) -> str:
        quoted = pattern.replace("'", "''")
        return f"""
          SELECT row, owner, {kind} AS kind, before + gap AS first, before + gap + size AS last, value, digits,
                 distinct_chars
          FROM (
            SELECT *, length(regexp_replace(value, '[^0-9]', '', 'g')) AS digits,
                   length(value) AS size_of_value,
                   len(list_distinct(string_split(value, ''))) AS distinct_chars
            FROM (
              SELECT row, owner, value, size, gap,
                     coalesce(sum(gap + size) OVER (PARTITION BY row ORDER BY i
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
              FROM (
                SELECT row, owner, unnest(range(1, len(m) + 1)) AS i, unnest(g) AS value,
                       unnest(list_transform(m, lambda x: length(x))) AS size,
                       unnest(list_transform(b[1:len(m)], lambda x: length(x))) AS gap
                FROM (SELECT row, owner, regexp_extract_all(text, '{quoted}') AS m,
                             regexp_extract_all(text, '{quoted}', {group}) AS g,
                             regexp_split_to_array(text, '{quoted}') AS b FROM docs)
                WHERE len(m) > 0)))
          WHERE {keep}"""

    union = " UNION ALL ".join(found(*kind) for kind in kinds)
    names = " ".join(f"WHEN {i} THEN '{name}'" for i, name in enumerate(secrets.KINDS))
    listed = "string_agg(name || ':' || first || ':' || last, ',' ORDER BY first, kind)"
    counts = ", ".join(f"count(*) FILTER (kind = {i})::BIGINT AS n_{secrets.KINDS[i]}" for i in range(3))
    return f"""WITH docs AS (
        SELECT row_number() OVER () AS row, doc_id, coalesce(source, '') AS owner,
               coalesce(text, '') AS text FROM documents),
      found AS ({union}),
      owners AS (SELECT value, count(DISTINCT owner) AS n FROM found GROUP BY value),
      judged AS (
        SELECT row, kind, CASE kind {names} END AS name, first::BIGINT AS first, last::BIGINT AS last,
               CASE WHEN distinct_chars < {secrets.PLAIN_DISTINCT} OR digits = 0 THEN 'plain'
                    WHEN n > {secrets.MOST_OWNERS} THEN 'copied' ELSE 'live' END AS verdict
        FROM found JOIN owners USING (value)),
      kept AS (
        SELECT * FROM judged j WHERE kind < 3 OR (verdict = 'live' AND NOT EXISTS (
          SELECT 1 FROM judged b
          WHERE b.row = j.row AND b.kind < 3 AND b.first < j.last AND b.last > j.first))),
      spans AS (
        SELECT row, {counts}, {listed} FILTER (kind < 3) AS base, {listed} AS spans,
               string_agg(verdict, ',' ORDER BY first, kind) AS verdicts,
               count(*) FILTER (verdict = 'live')::BIGINT AS n_live,
               count(*) FILTER (verdict = 'copied')::BIGINT AS n_copied
        FROM kept GROUP BY row)
      SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
             coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
             coalesce(spans, '') AS spans, coalesce(verdicts, '') AS verdicts,
             coalesce(n_live, 0) AS n_live, coalesce(n_copied, 0) AS n_copied
      FROM docs LEFT JOIN spans USING (row)"""


def _phrase_collocations() -> str:
    part = "split_part(phrase, ' ', {})"
    first, second, third = (part.format(i) for i in (1, 2, 3))
    return rf"""WITH pieces AS (
        SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w
        FROM (SELECT coalesce(lang, 'und') AS lang,
                     unnest(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
                                               '[.,;:!?\x0A-\x0D]')) AS piece
              FROM documents)),
      grams AS (
        SELECT lang, 1 AS size, unnest(w) AS phrase FROM pieces
        UNION ALL
        SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))
        FROM pieces
        UNION ALL
        SELECT lang, 3, unnest(list_transform(range(1, len(w) - 1),
                                              lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))
        FROM pieces),
      counts AS (SELECT lang, size, phrase, count(*) AS f FROM grams GROUP BY lang, size, phrase),
      totals AS (SELECT lang, sum(f) AS n FROM counts WHERE size = 1 GROUP BY lang),
      candidates AS (SELECT * FROM counts WHERE size > 1 AND f >= {phrases.LEAST}),
      cuts AS (
        SELECT lang, phrase, f AS a, 1 AS k, {first} AS front,
               CASE size WHEN 2 THEN {second} ELSE {second} || ' ' || {third} END AS rest
        FROM candidates
        UNION ALL
        SELECT lang, phrase, f, 2, {first} || ' ' || {second}, {third} FROM candidates WHERE size = 3),
      scored AS (
        SELECT c.lang, c.phrase, a, k, x.f AS l, y.f AS r,
               (1000000::HUGEINT * a * a) // (x.f::HUGEINT * y.f) AS score
        FROM cuts c JOIN counts x ON x.lang = c.lang AND x.phrase = c.front
        JOIN counts y ON y.lang = c.lang AND y.phrase = c.rest),
      lowest AS (SELECT * FROM scored
                 QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
      longer AS (
        SELECT lang, {first} || ' ' || {second} AS phrase, f FROM candidates WHERE size = 3
        UNION ALL SELECT lang, {second} || ' ' || {third}, f FROM candidates WHERE size = 3),
      kept AS (SELECT * FROM lowest s WHERE NOT EXISTS (
        SELECT 1 FROM longer g WHERE g.lang = s.lang AND g.phrase = s.phrase AND 100 * g.f >= 50 * s.a)),
      ranked AS (SELECT *, row_number() OVER (
        PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
      SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r,
             n::BIGINT AS n, score::BIGINT AS score
      FROM ranked JOIN totals USING (lang) WHERE rank <= {phrases.BEST}"""


ORACLE: dict[str, str] = {
    "op3_minmax_near_duplicates": _near_duplicates(),
    "op4_cap_near_vectors": _near_vectors(),
    "op8_quality_rules": _quality_rules(),
    "op11_phrase_collocations": _phrase_collocations(),
    "op12_conversation_trie": _conversation_trie(),
    "op13_secret_ownership": _secret_ownership(),
}
