"""The registered queries in plain SQL, written for DuckDB and apart from the library's code."""

from __future__ import annotations

from pairstats.functions.words import ENGLISH_STOP_WORDS, HEBREW_STOP_WORDS

LATIN = "".join(chr(ord("a") + i) for i in range(26))
HEBREW = "".join(chr(0x05D0 + i) for i in range(26))


def _values(words: list[str]) -> str:
    return ", ".join("('" + word.replace("'", "''") + "')" for word in words)


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(parts)


def _score(expression: str, name: str) -> str:
    return f"round({expression}, 6) + 0.0::DOUBLE AS {name}"


DOC_PAIRS = """
words AS (
  SELECT doc_id, lang,
         list_filter(string_split_regex(text, '[ \\t\\r\\n]+'), lambda w: w <> '') AS w
  FROM documents),
zipped AS (
  SELECT doc_id, lang, unnest(list_zip(w[1:len(w) - 1], w[2:len(w)])) AS pair
  FROM words WHERE len(w) > 1),
adjacent AS (SELECT doc_id, lang, pair[1] AS w1, pair[2] AS w2 FROM zipped)"""

DOC_FACTS = """
facts AS (
  SELECT lang, w1, w2, CAST(1900 + doc_id % 100 AS INTEGER) AS year, 1::BIGINT AS match_count
  FROM adjacent)"""

HEBREW_FACTS = f"""
facts AS (
  SELECT translate(w1, '{LATIN}', '{HEBREW}') AS w1, translate(w2, '{LATIN}', '{HEBREW}') AS w2,
         CAST(1900 + doc_id % 100 AS INTEGER) AS year, 1::BIGINT AS match_count
  FROM adjacent)"""

PRODUCT_FACTS = """
facts AS (
  SELECT split_part(p_name, ' ', 1) AS w1, split_part(p_name, ' ', 2) AS w2,
         CAST(year(o_orderdate) AS INTEGER) AS year, CAST(count(*) AS BIGINT) AS match_count
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN part ON l_partkey = p_partkey
  GROUP BY 1, 2, 3)"""

LINES = """
lines AS (
  SELECT concat_ws(chr(9),
           CASE doc_id % 10 WHEN 1 THEN w1 WHEN 2 THEN w1 || ' ' || w2 || ' ' || w1
             WHEN 3 THEN w1 || '  ' || w2 WHEN 4 THEN w1 || ' ' || w2 || ' '
             ELSE w1 || ' ' || w2 END,
           CAST(1900 + doc_id % 100 AS VARCHAR) || CASE doc_id % 10 WHEN 5 THEN 'x' ELSE '' END,
           CASE doc_id % 10 WHEN 6 THEN '0' ELSE '3' END,
           CASE doc_id % 10 WHEN 7 THEN chr(9) ELSE '2' || chr(9) || '1' END) AS line
  FROM adjacent),
fields AS (SELECT line, string_split(rtrim(line, chr(9)), chr(9)) AS f FROM lines),
tokens AS (SELECT line, f, string_split(rtrim(f[1], ' '), ' ') AS t FROM fields),
parsed AS (
  SELECT line, len(f) >= 4 AS complete,
         CASE WHEN len(t) = 2 AND t[1] <> '' AND t[2] <> '' THEN t[1] END AS w1,
         CASE WHEN len(t) = 2 AND t[1] <> '' AND t[2] <> '' THEN t[2] END AS w2,
         len(f) >= 4 AND regexp_full_match(f[2], '[+-]?[0-9]+')
           AND regexp_full_match(f[3], '[+-]?[0-9]+') AS numeric,
         try_cast(f[2] AS INTEGER) AS year, try_cast(f[3] AS BIGINT) AS match_count,
         try_cast(f[4] AS BIGINT) AS page_count, try_cast(f[5] AS BIGINT) AS volume_count
  FROM tokens)"""

LETTERS = """
letters AS (
  SELECT * FROM facts
  WHERE regexp_full_match(lower(w1), '[a-z]+') AND regexp_full_match(lower(w2), '[a-z]+'))"""

CLEAN = """
clean AS (
  SELECT CAST(year - year % 10 AS INTEGER) AS period, w1, w2, match_count
  FROM letters
  WHERE lower(w1) NOT IN (SELECT word FROM stop) AND lower(w2) NOT IN (SELECT word FROM stop))"""

HEBREW_CLEAN = """
clean AS (
  SELECT CAST(year - year % 10 AS INTEGER) AS period, w1, w2, match_count
  FROM facts
  WHERE regexp_full_match(w1, '[\\x{05D0}-\\x{05EA}]+')
    AND regexp_full_match(w2, '[\\x{05D0}-\\x{05EA}]+')
    AND w1 NOT IN (SELECT word FROM stop) AND w2 NOT IN (SELECT word FROM stop))"""

PAIRS = """
pairs AS (
  SELECT period, w1, w2, CAST(sum(match_count) AS BIGINT) AS c12
  FROM clean GROUP BY period, w1, w2)"""

COUNTED = """
counted AS (
  SELECT period, w1, w2, c12,
         CAST(sum(c12) OVER (PARTITION BY period, w1) AS BIGINT) AS c1,
         CAST(sum(c12) OVER (PARTITION BY period, w2) AS BIGINT) AS c2,
         CAST(sum(c12) OVER (PARTITION BY period) AS BIGINT) AS n
  FROM pairs)"""

SCORED = """
logs AS (
  SELECT *, ln(c12) + ln(n) - ln(c1) - ln(c2) AS pmi, -(ln(c12) - ln(n)) AS self
  FROM counted),
scored AS (SELECT *, CASE WHEN self <> 0 THEN pmi / self END AS npmi FROM logs),
summed AS (SELECT *, sum(npmi) OVER (PARTITION BY period) AS npmi_sum FROM scored),
scores AS (
  SELECT *, CASE WHEN npmi_sum <> 0 THEN npmi / npmi_sum END AS rel_npmi FROM summed)"""

CHOSEN = "chosen AS (SELECT * FROM scores WHERE npmi >= 0.7 OR rel_npmi >= 0.3)"

SCORED_LINES = r"""
made AS (
  SELECT doc_id % 10 AS d, doc_id, w1, w2, CAST(length(w1) AS VARCHAR) AS n1,
         CAST(length(w2) AS VARCHAR) AS n2,
         CASE doc_id % 10 WHEN 3 THEN 'x' ELSE '' END
           || CASE doc_id % 10 WHEN 7 THEN '\N' ELSE CAST(1900 + doc_id % 100 AS VARCHAR) END AS p
  FROM adjacent),
scored_lines AS (
  SELECT p || ' ' || w1
           || CASE d WHEN 1 THEN '' WHEN 2 THEN ' ' || w2 || ' ' || w1 WHEN 8 THEN ' ' ELSE ' ' || w2 END
           || CASE WHEN doc_id % 20 = 0 THEN '' ELSE chr(9)
           || CASE d WHEN 4 THEN n1 WHEN 5 THEN n1 || ' y' || n2 WHEN 6 THEN '\N ' || n2
                WHEN 9 THEN n1 || ' ' || n2 || ' ' || n1 ELSE n1 || ' ' || n2 END END AS value
  FROM made),
cut AS (
  SELECT value, string_split(value, chr(9)) AS f, string_split(split_part(value, chr(9), 1), ' ') AS k,
         string_split(split_part(value, chr(9), 2), ' ') AS v
  FROM scored_lines),
judged AS (
  SELECT *, CASE WHEN len(f) < 2 OR len(k) < 3 THEN 'few_fields'
              WHEN len(f) > 2 OR len(k) > 3 OR len(v) > 2 THEN 'many_fields'
              WHEN k[1] <> '\N' AND try_cast(k[1] AS INTEGER) IS NULL THEN 'bad_period'
              WHEN k[2] = '' OR k[3] = '' THEN 'empty_word'
              WHEN len(v) < 2 THEN 'few_values'
              WHEN len(list_filter(v, lambda x: x <> '\N' AND try_cast(x AS BIGINT) IS NULL)) > 0
                THEN 'bad_value' END AS reason
  FROM cut)"""

REASON = """
  CASE WHEN NOT complete THEN 'few_fields'
       WHEN w1 IS NULL THEN 'not_two_words'
       WHEN lower(w1) IN (SELECT word FROM stop) OR lower(w2) IN (SELECT word FROM stop)
         THEN 'stop_word'
       WHEN NOT regexp_full_match(lower(w1), '[a-z]+')
         OR NOT regexp_full_match(lower(w2), '[a-z]+') THEN 'non_letter'
       WHEN NOT numeric OR year IS NULL OR match_count IS NULL OR match_count <= 0
         THEN 'bad_number' END"""

BEST = """
best AS (
  SELECT period, w1, w2, npmi, CAST(row_number() OVER (
    PARTITION BY period ORDER BY round(npmi, 9) DESC NULLS LAST, w1, w2) AS INTEGER) AS rank
  FROM scores)"""


def statements() -> dict[str, str]:
    """Query name -> SQL, for each registered query whose rows SQL can state."""
    stop = f"stop(word) AS (VALUES {_values(ENGLISH_STOP_WORDS)})"
    hebrew_stop = f"stop(word) AS (VALUES {_values(HEBREW_STOP_WORDS)})"

    doc_clean = _with(stop, DOC_PAIRS, DOC_FACTS, LETTERS, CLEAN)
    doc_pairs = _with(stop, DOC_PAIRS, DOC_FACTS, LETTERS, CLEAN, PAIRS)
    doc_counted = f"{doc_pairs},{COUNTED}"
    doc_scores = f"{doc_counted},{SCORED}"
    products = _with(stop, PRODUCT_FACTS, LETTERS, CLEAN, PAIRS)
    product_counted = f"{products},{COUNTED}"
    product_scores = f"{product_counted},{SCORED}"
    hebrew = _with(hebrew_stop, DOC_PAIRS, HEBREW_FACTS, HEBREW_CLEAN)
    lines = _with(stop, DOC_PAIRS, LINES)
    line_pairs = f"""{lines},
      facts AS (SELECT * FROM parsed WHERE numeric AND w1 IS NOT NULL AND match_count > 0
                AND year IS NOT NULL),{LETTERS},{CLEAN},{PAIRS}
      SELECT period, w1, w2, c12 FROM pairs"""

    npmi, rel = _score("npmi", "npmi"), _score("rel_npmi", "rel_npmi")
    all_counts = "period, w1, w2, c12, c1, c2, n"

    return {
        "parse_ngram_lines": f"""{lines}
            SELECT line, complete, numeric, w1, w2, year, match_count, page_count, volume_count
            FROM parsed""",
        "ngrams_text_round_trip": line_pairs,
        "ngrams_sequence_round_trip": line_pairs,
        "ngrams_table_round_trip": f"{doc_pairs} SELECT period, w1, w2, c12 FROM pairs",
        "corpus_by_language": f"""{_with(
            stop, DOC_PAIRS, DOC_FACTS,
            LETTERS.replace("FROM facts", "FROM (SELECT * FROM facts WHERE lang = 'en')"),
            CLEAN, PAIRS)}
            SELECT period, w1, w2, c12 FROM pairs""",
        "reject_reasons": f"""{lines}
            SELECT coalesce({REASON}, 'kept') AS reason, CAST(count(*) AS BIGINT) AS n_rows
            FROM parsed GROUP BY 1""",
        "rejected_lines": f"""{lines}
            SELECT line, reason FROM (SELECT line, {REASON} AS reason FROM parsed)
            WHERE reason IS NOT NULL""",
        "split_by_outcome": f"""{lines}
            SELECT line, coalesce({REASON}, 'kept') AS outcome FROM parsed""",
        "scored_lines_good": f"""{_with(DOC_PAIRS, SCORED_LINES)}
            SELECT try_cast(k[1] AS INTEGER) AS period, k[2] AS w1, k[3] AS w2,
                   try_cast(v[1] AS BIGINT) AS n1, try_cast(v[2] AS BIGINT) AS n2
            FROM judged WHERE reason IS NULL""",
        "scored_lines_rejected": f"""{_with(DOC_PAIRS, SCORED_LINES)}
            SELECT value, reason FROM judged WHERE reason IS NOT NULL""",
        "clean_pairs_english": f"{doc_clean} SELECT period, w1, w2, match_count FROM clean",
        "clean_pairs_fold_case": f"""{doc_clean}
            SELECT period, lower(w1) AS w1, lower(w2) AS w2,
                   CAST(sum(match_count) AS BIGINT) AS c12
            FROM clean GROUP BY 1, 2, 3""",
        "clean_pairs_hebrew": f"{hebrew} SELECT period, w1, w2, match_count FROM clean",
        "stop_word_anti_join": f"""{_with(stop, DOC_PAIRS, DOC_FACTS, LETTERS)}
            SELECT CAST(year - year % 10 AS INTEGER) AS period, w1, w2, match_count
            FROM letters
            WHERE NOT EXISTS (SELECT 1 FROM stop WHERE word = lower(w1))
              AND NOT EXISTS (SELECT 1 FROM stop WHERE word = lower(w2))""",
        "stop_word_table": f"""{_with(stop, DOC_PAIRS)}
            SELECT word, CAST(count(s.w) AS BIGINT) AS n_rows
            FROM stop LEFT JOIN (SELECT lower(unnest(w)) AS w FROM words) AS s ON word = s.w
            GROUP BY word""",
        "clean_pairs_own_list": f"""{_with(DOC_PAIRS, DOC_FACTS, LETTERS)}
            SELECT CAST(year - year % 10 AS INTEGER) AS period, w1, w2,
                   CAST(sum(match_count) AS BIGINT) AS c12
            FROM letters
            WHERE lower(w1) NOT IN ('the', 'of', 'and') AND lower(w2) NOT IN ('the', 'of', 'and')
            GROUP BY 1, 2, 3""",
        "period_buckets": f"""{_with(DOC_PAIRS, DOC_FACTS)}
            SELECT CAST(year - year % 10 AS INTEGER) AS decade,
                   CAST(year - year % 25 AS INTEGER) AS quarter,
                   CAST(sum(match_count) AS BIGINT) AS n
            FROM facts GROUP BY 1, 2""",
        "hash_sample": """
            SELECT o_orderkey, o_custkey FROM orders
            WHERE CAST('0x' || substr(md5(concat_ws(chr(9), o_orderkey, o_custkey)), 1, 8)
                       AS BIGINT) < 2147483648""",
        "row_sample": f"""{_with(DOC_PAIRS, DOC_FACTS)}
            SELECT CAST(count(*) AS BIGINT) AS n_rows, true AS share_in_bounds,
                   true AS all_in_whole FROM facts""",
        "pair_counts": f"{doc_pairs} SELECT period, w1, w2, c12 FROM pairs",
        "left_counts": f"""{doc_clean}
            SELECT period, w1, CAST(sum(match_count) AS BIGINT) AS c1 FROM clean GROUP BY 1, 2""",
        "right_counts": f"""{doc_clean}
            SELECT period, w2, CAST(sum(match_count) AS BIGINT) AS c2 FROM clean GROUP BY 1, 2""",
        "period_totals": f"""{doc_clean}
            SELECT period, CAST(sum(match_count) AS BIGINT) AS n FROM clean GROUP BY 1""",
        "count_levels": f"""{doc_clean}
            SELECT period, w1, w2, CAST(grouping(period, w1, w2) AS INTEGER) AS level,
                   CAST(sum(match_count) AS BIGINT) AS total
            FROM clean
            GROUP BY GROUPING SETS ((period, w1, w2), (period, w1), (period, w2), (period))""",
        "with_left_count": f"{doc_counted} SELECT period, w1, w2, c12, c1 FROM counted",
        "with_right_count": f"{doc_counted} SELECT period, w1, w2, c12, c2 FROM counted",
        "with_period_total": f"{doc_counted} SELECT period, w1, w2, c12, n FROM counted",
        "association_counts": f"{doc_counted} SELECT {all_counts} FROM counted",
        "association_counts_stop_table": f"{doc_counted} SELECT {all_counts} FROM counted",
        "association_counts_buckets": f"{doc_counted} SELECT {all_counts} FROM counted",
        "association_counts_products": f"""
            {product_counted.replace("year % 10", "year % 5")} SELECT {all_counts} FROM counted""",
        "reverse_pair_view": f"""{products}
            SELECT period, w2 AS w1, w1 AS w2, c12,
                   CAST(period AS VARCHAR) || ' ' || w2 || ' ' || w1 AS pair_key
            FROM pairs""",
        "pmi_npmi": f"""{product_scores}
            SELECT {all_counts}, {_score("pmi", "pmi")}, {npmi} FROM scores""",
        "npmi_totals": f"""{doc_scores}
            SELECT period, {_score("sum(npmi)", "npmi_sum")} FROM scores GROUP BY period""",
        "relative_npmi": f"{product_scores} SELECT {all_counts}, {npmi}, {rel} FROM scores",
        "association_scores": f"{doc_scores} SELECT {all_counts}, {npmi}, {rel} FROM scores",
        "select_either_threshold": f"""{product_scores}
            SELECT {all_counts}, {npmi}, {rel} FROM scores
            WHERE npmi >= 0.05 OR rel_npmi >= 0.5""",
        "collocations_ranked": f"""{doc_scores}, {CHOSEN}
            SELECT period, w1, w2, {npmi} FROM chosen ORDER BY period, scores.npmi DESC, w1, w2
            """.replace("scores.npmi", "chosen.npmi"),
        "collocations_hebrew": f"""{hebrew},{PAIRS},{COUNTED},{SCORED}, {CHOSEN}
            SELECT period, w1, w2, {npmi} FROM chosen""",
        "one_per_score": f"""{doc_scores}, {CHOSEN},
            numbered AS (
              SELECT *, row_number() OVER (
                PARTITION BY period, round(npmi, 9) ORDER BY w1, w2) AS place
              FROM chosen)
            SELECT period, w1, w2, {npmi} FROM numbered WHERE place = 1""",
        "top_k_per_period": f"""{doc_scores},{BEST}
            SELECT period, rank, w1, w2, {npmi} FROM best WHERE rank <= 10""",
        "top_k_large": f"""{doc_scores},{BEST}
            SELECT period, rank, w1, w2, {npmi} FROM best WHERE rank <= 1500""",
        "delivered_order": f"""{doc_scores}
            SELECT CAST(row_number() OVER (
                     ORDER BY period, round(npmi, 9) DESC NULLS LAST, w1, w2) AS BIGINT) AS position,
                   period, w1, w2, {npmi}
            FROM scores""",
        "stage_counts": f"""{doc_scores}, {CHOSEN}
            SELECT 'input' AS stage, CAST(count(*) AS BIGINT) AS n_rows FROM facts
            UNION ALL SELECT 'kept', count(*) FROM clean
            UNION ALL SELECT 'pairs', count(*) FROM pairs
            UNION ALL SELECT 'scored', count(*) FROM scores
            UNION ALL SELECT 'selected', count(*) FROM chosen
            UNION ALL SELECT 'distinct_scores', count(*)
              FROM (SELECT DISTINCT period, round(npmi, 9) FROM chosen)""",
        "run_counters": f"""{doc_scores}, {CHOSEN}
            SELECT 'input' AS stage, CAST(count(*) AS BIGINT) AS n_rows FROM facts
            UNION ALL SELECT 'kept', count(*) FROM clean
            UNION ALL SELECT 'pairs', count(*) FROM pairs
            UNION ALL SELECT 'scored', count(*) FROM scores
            UNION ALL SELECT 'selected', count(*) FROM chosen""",
        "text_with_nulls": rf"""{doc_pairs}
            SELECT CASE WHEN length(w1) % 5 > 0 THEN period END AS period,
                   CASE length(w2) % 7 WHEN 0 THEN w1 || ' \N' || chr(9) || '\s' WHEN 1 THEN NULL
                     ELSE w1 END AS w1,
                   CASE WHEN length(w1) % 6 = 0 THEN '\' || w2 || chr(13) || chr(10) ELSE w2 END AS w2,
                   CASE WHEN length(w2) % 3 > 0 THEN c12 END AS c12, c12 + 1 AS further,
                   CASE WHEN length(w1) % 4 > 0 THEN w2 || ' ' || w1 END AS words
            FROM pairs""",
        "stage_parquet_round_trip": f"{doc_pairs} SELECT period, w1, w2, c12 FROM pairs",
        "scored_text_round_trip": f"{doc_scores} SELECT period, w1, w2, {npmi}, {rel} FROM scores",
        "counts_text_round_trip": f"{doc_counted} SELECT period, w1, w2, c12, c1, c2 FROM counted",
        "top_k_report_round_trip": f"""{doc_scores},{BEST}
            SELECT period, w1, w2, {npmi} FROM best WHERE rank <= 10""",
    }
