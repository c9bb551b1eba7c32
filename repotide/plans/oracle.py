"""The same results as plain SQL, written independently of the DataFrame code."""

from __future__ import annotations

_LETTERS = "regexp_replace({text}, '[^a-zA-Z ]', '', 'g')"

# Documents as repositories, known by their texts.
_REPOS = "repos AS (SELECT doc_id, text AS id, lang, text, n_chars FROM documents)"

# The first copy of each.
_ONCE = f"""{_REPOS},
once AS (
  SELECT * FROM repos WHERE id IS NOT NULL AND lang IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY doc_id) = 1
)"""


def _top_words(rows: str, text: str = "text", keep_empty: bool = False) -> str:
    keep = "" if keep_empty else "WHERE word <> ''"
    return f"""
tokens AS (
  SELECT lang, unnest(string_split({_LETTERS.format(text=text)}, ' ')) AS word FROM {rows}
  WHERE lang IS NOT NULL AND text IS NOT NULL
),
counted AS (
  SELECT lang, word, count(*) AS freq FROM tokens {keep} GROUP BY lang, word
),
ranked AS (
  SELECT lang, word, freq, row_number() OVER (PARTITION BY lang ORDER BY freq DESC, word) AS rnk
  FROM counted
  QUALIFY row_number() OVER (PARTITION BY lang ORDER BY freq DESC, word) <= 10
)"""


_TOP = 'SELECT lang AS "Language", word AS "Word", freq AS "Freq" FROM ranked'
_WORD_LIST = "string_agg('(' || word || ',' || freq || ')', ',' ORDER BY rnk)"


def _batch(seconds: int) -> str:
    """End of the batch a push falls into."""
    return f"time_bucket(INTERVAL {seconds} SECOND, ts) + INTERVAL {seconds} SECOND"


_RECENT = f"""
newest AS (
  SELECT {_batch(300)} AS batch_time, event_type, user_id, max(ts) AS ts
  FROM events GROUP BY ALL
),
recent AS (
  SELECT batch_time, event_type, count(*) FILTER (ts >= batch_time - INTERVAL 60 SECOND) AS n
  FROM newest GROUP BY ALL
)"""

_LABEL = "CASE WHEN user_id % 9 = 0 THEN 'Yes' ELSE 'No' END"
_PUSHED = "1704067200 + doc_id * 60"
_N_WORDS = f"len(list_filter(string_split({_LETTERS.format(text='text')}, ' '), lambda w: w <> ''))"

_TRACKED = "(VALUES (0, 'en'), (1, 'de'), (2, 'fr'), (3, 'pt')) AS t(pos, lang)"

ORACLE = {
    "top10_words": f"WITH {_REPOS}, {_top_words('repos')} {_TOP}",
    "top10_words_folded": f"WITH {_REPOS}, {_top_words('repos', 'lower(text)')} {_TOP}",
    "top10_tokens": f"WITH {_REPOS}, {_top_words('repos', keep_empty=True)} {_TOP}",
    "top10_words_dedup": f"WITH {_ONCE}, {_top_words('once')} {_TOP}",
    "word_lists": f"""
        WITH {_REPOS}, {_top_words('repos')}
        SELECT lang AS "Language", {_WORD_LIST} AS words FROM ranked GROUP BY lang""",
    "columns_export": f"""
        WITH {_ONCE}, c AS (SELECT lang, count(*) AS n FROM once GROUP BY lang)
        SELECT string_agg(lang, ',' ORDER BY lang) AS lang,
               string_agg(n::VARCHAR, ',' ORDER BY lang) AS count
        FROM c""",
    "repo_totals": f"WITH {_ONCE} SELECT lang, count(*) AS count FROM once GROUP BY lang",
    "avg_stars": f"""
        WITH {_ONCE}
        SELECT lang AS "Language", sum(n_chars)::DOUBLE / count(*) AS "Average_Stars"
        FROM once GROUP BY lang""",
    "avg_stars_join": f"""
        WITH {_ONCE},
        c AS (SELECT lang, count(*) AS n FROM once GROUP BY lang),
        s AS (SELECT lang, sum(n_chars) AS stars FROM once GROUP BY lang)
        SELECT lang AS "Language", stars::DOUBLE / n AS "Average_Stars" FROM c JOIN s USING (lang)""",
    "totals_zero_filled": f"""
        WITH {_ONCE}, c AS (SELECT lang, count(*) AS n FROM once GROUP BY lang)
        SELECT t.lang, coalesce(n, 0) AS count FROM {_TRACKED} LEFT JOIN c ON c.lang = t.lang""",
    "stars_zero_filled": f"""
        WITH {_ONCE},
        c AS (SELECT lang, sum(n_chars)::DOUBLE / count(*) AS a FROM once GROUP BY lang)
        SELECT t.lang AS "Language", coalesce(a, 0.0) AS "Average_Stars"
        FROM {_TRACKED} LEFT JOIN c ON c.lang = t.lang""",
    "language_bucket": f"""
        WITH {_REPOS}
        SELECT CASE lower(lang) WHEN 'en' THEN 'English' WHEN 'fr' THEN 'French' ELSE 'Other' END
               AS bucket, count(*) AS count FROM repos GROUP BY 1""",
    "rejected_rows": f"""
        WITH {_REPOS}
        SELECT doc_id, lang AS language, CASE WHEN lang IS NULL THEN 'no language'
               WHEN id IS NULL THEN 'no key' ELSE 'duplicate' END AS reason
        FROM repos
        QUALIFY lang IS NULL OR id IS NULL
             OR row_number() OVER (PARTITION BY id, lang IS NULL ORDER BY doc_id) > 1""",
    "union_feeds": """
        SELECT doc_id, lang AS language, n_chars FROM documents WHERE lang = 'en'
        UNION ALL SELECT doc_id, lang, n_chars FROM documents WHERE lang = 'de'
        UNION ALL SELECT doc_id, lang, n_chars FROM documents WHERE lang = 'fr'
        UNION ALL SELECT doc_id, lang, n_chars FROM documents WHERE lang = 'pt'
        UNION ALL SELECT doc_id, lang, n_chars FROM documents
        WHERE lang IS NULL OR lang NOT IN ('en', 'de', 'fr', 'pt')""",
    "recent_per_batch": f"""
        WITH {_RECENT}
        SELECT batch_time, event_type AS "Language", n AS "Recents" FROM recent""",
    "recent_last10": f"""
        WITH {_RECENT}
        SELECT batch_time, event_type AS "Language", n AS "Recents",
               row_number() OVER (PARTITION BY event_type ORDER BY batch_time DESC)::INTEGER AS rank
        FROM recent
        QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY batch_time DESC) <= 10""",
    "latest_snapshot": f"""
        WITH b AS (SELECT {_batch(86400)} AS batch_time, event_type FROM events)
        SELECT batch_time, event_type AS language, count(*) AS count FROM b
        WHERE batch_time = (SELECT max(batch_time) FROM b) GROUP BY ALL""",
    "dashboard_series": f"""
        WITH {_RECENT},
        last AS (SELECT DISTINCT batch_time FROM recent ORDER BY batch_time DESC LIMIT 10),
        grid AS (
          SELECT batch_time, event_type FROM last,
          (VALUES ('click'), ('view'), ('error'), ('refund')) AS t(event_type)
        )
        SELECT batch_time, strftime(batch_time, '%H:%M:%S') AS label, event_type AS "Language",
               coalesce(n, 0) AS "Recents"
        FROM grid LEFT JOIN recent USING (batch_time, event_type)""",
    "age_label_counts": f"""
        WITH b AS (SELECT {_batch(300)} AS batch_time, ts FROM events)
        SELECT batch_time,
               CASE WHEN ts <= batch_time - INTERVAL 60 SECOND THEN 'old' ELSE 'recent' END AS label,
               count(*) AS count
        FROM b GROUP BY ALL""",
    "poll_dedup": f"""
        WITH newest AS (
          SELECT {_batch(86400)} AS poll, event_type AS language, user_id AS id,
                 max(ts) AS pushed_at
          FROM events GROUP BY ALL
        ),
        ranked AS (
          SELECT *, row_number() OVER (
            PARTITION BY poll, language ORDER BY pushed_at DESC, id)::INTEGER AS rank
          FROM newest
        )
        SELECT * FROM ranked WHERE rank <= 50""",
    "batch_dedup": f"""
        WITH b AS (SELECT {_batch(86400)} AS batch_time, * FROM events)
        SELECT batch_time, user_id AS id, event_id AS seq, event_type AS language FROM b
        QUALIFY row_number() OVER (PARTITION BY batch_time, user_id ORDER BY event_id) = 1""",
    "nine_multiples": f"""
        SELECT {_LABEL} AS "isMultipleOf9", count(*) AS count FROM events GROUP BY 1""",
    "nine_tumbling_20s": f"""
        SELECT time_bucket(INTERVAL 20 SECOND, ts) AS window_start, {_LABEL} AS "isMultipleOf9",
               count(*) AS count
        FROM events GROUP BY ALL""",
    "stream_avg_stars_join": """
        WITH w AS (
          SELECT doc_id // 100 AS w, lang, sum(n_chars)::DOUBLE / count(*) AS a FROM documents
          WHERE lang IS NOT NULL GROUP BY ALL)
        SELECT TIMESTAMP '2024-01-01' + w * INTERVAL 100 SECOND AS window_start, lang AS "Language",
               a AS "Average_Stars"
        FROM w WHERE (w + 1) * 100 <= (SELECT max(doc_id) FROM documents) - 10""",
    "stream_union_feeds": """
        WITH last AS (SELECT lang, max(doc_id) AS doc_id FROM documents GROUP BY lang)
        SELECT TIMESTAMP '2024-01-01' + doc_id // 100 * INTERVAL 100 SECOND AS window_start,
               lang AS language, count(*) AS count
        FROM documents WHERE (doc_id // 100 + 1) * 100 <= (SELECT min(doc_id) FROM last) GROUP BY ALL""",
    "stream_first_numbers": """
        SELECT event_id AS seq, user_id AS id, event_type AS language FROM events
        WHERE user_id IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id) = 1""",
    "sliding_counts": f"""
        WITH n AS (
          SELECT unnest(generate_series(0, 59)) * INTERVAL 5 SECOND AS back,
                 time_bucket(INTERVAL 5 SECOND, ts) AS pane, {_LABEL} AS label FROM events)
        SELECT pane - back AS window_start, label AS "isMultipleOf9", count(*) AS count FROM n GROUP BY ALL""",
    "stream_sliding_counts": f"""
        WITH n AS (
          SELECT time_bucket(INTERVAL 600 SECOND, ts) + INTERVAL 600 SECOND AS pane_end, {_LABEL} AS label
          FROM events),
        w AS (
          SELECT pane_end + unnest(generate_series(0, 5)) * INTERVAL 600 SECOND AS window_end, label FROM n)
        SELECT window_end, label AS "isMultipleOf9", count(*) AS count FROM w
        WHERE window_end < (SELECT max(pane_end) FROM n) GROUP BY ALL""",
    "stream_every_boundary": """
        WITH n AS (
          SELECT time_bucket(INTERVAL 6 HOUR, ts) + INTERVAL 6 HOUR AS pane_end, event_type FROM events),
        b AS (
          SELECT unnest(generate_series(min(pane_end), max(pane_end) - INTERVAL 6 HOUR, INTERVAL 6 HOUR))
            AS boundary FROM n)
        SELECT boundary, event_type AS language, count(*) AS count FROM b JOIN n ON pane_end <= boundary
        GROUP BY ALL""",
    "digits_text": """
        SELECT o_orderkey AS "A",
               array_to_string(string_split((o_custkey + 10000)::VARCHAR, ''), ',') AS "B"
        FROM orders""",
    "digit_histogram": """
        SELECT digit, count(*) AS count
        FROM (SELECT unnest(string_split((o_orderkey + 10000)::VARCHAR, '')) AS digit FROM orders)
        GROUP BY digit""",
    "odd_numbers_first10": """
        SELECT o_orderkey FROM orders WHERE o_orderkey % 2 <> 0 ORDER BY o_orderkey LIMIT 10""",
    "head_15": """
        SELECT o_custkey AS "A", o_orderkey AS "B" FROM orders ORDER BY o_orderkey LIMIT 15""",
    "sql_filter_ci": "SELECT p_partkey, p_size FROM part WHERE p_size < 4",
    "sql_filter_star": "SELECT * FROM part WHERE p_size < 4",
    "sql_count_filter": "SELECT count(p_size) AS n FROM part WHERE p_size < 4",
    "csv_roundtrip": """
        SELECT o_custkey AS "A", count(*) AS n, sum(o_orderkey)::BIGINT AS sum_b
        FROM orders GROUP BY o_custkey""",
    "run_report": f"""
        WITH {_ONCE}, {_top_words('once')},
        c AS (
          SELECT lang, count(*) AS n, sum(n_chars)::DOUBLE / count(*) AS a FROM once GROUP BY lang
        ),
        w AS (SELECT lang, {_WORD_LIST} AS words FROM ranked GROUP BY lang)
        SELECT 1 AS line_no, (SELECT epoch(date_trunc('second', min(ts)))::BIGINT || ':' ||
               epoch(date_trunc('second', max(ts)))::BIGINT FROM events) AS line
        UNION ALL
        SELECT pos + 2, t.lang || ':' || coalesce(n, 0) || ':' || coalesce(a, 0.0::DOUBLE)
        FROM {_TRACKED} LEFT JOIN c ON c.lang = t.lang
        UNION ALL
        SELECT pos + 6, t.lang || ':' || coalesce(words, '')
        FROM {_TRACKED} LEFT JOIN w ON w.lang = t.lang""",
    "json_decode": """
        SELECT json_extract(props, '$.k')::BIGINT AS k, count(*) AS n FROM events GROUP BY 1""",
    "repo_json_roundtrip": f"""
        SELECT source || '/' || doc_id AS full_name, {_PUSHED} AS pushed_epoch,
               n_chars AS stargazers_count, {_N_WORDS}::INTEGER AS n_words, lang AS language
        FROM documents""",
    "tsv_decode": """
        WITH r AS (
          SELECT *, CASE WHEN event_id % 29 = 4 THEN 'malformed' WHEN event_id % 23 = 1 THEN 'no key'
            WHEN event_id % 7 = 3 OR event_id % 11 = 2 THEN 'unreadable field' END AS reason
          FROM events)
        SELECT CASE WHEN event_id % 23 <> 1 THEN event_id END AS event_id,
               CASE WHEN reason IS NULL THEN epoch(date_trunc('second', ts))::BIGINT END AS pushed_epoch,
               CASE WHEN reason IS NULL THEN user_id END AS user_id, props,
               CASE WHEN event_id % 29 <> 4 THEN event_type END AS event_type, reason
        FROM r""",
    "int_decode": """
        SELECT 'rows' AS part, count(*) AS n, sum(event_id)::BIGINT AS total FROM events
        UNION ALL SELECT 'rejects', count(*), 0 FROM events""",
    "envelope_unnest": f"""
        SELECT doc_id * 3 AS id, source || '/' || doc_id AS full_name,
               n_chars AS stargazers_count, {_N_WORDS}::INTEGER AS n_words, lang AS language
        FROM documents
        UNION ALL
        SELECT doc_id * 3 + 1, source || '/' || doc_id, n_chars, 0, lang FROM documents""",
    "capture_parse": f"""
        SELECT source || '/' || doc_id AS full_name, {_PUSHED} AS pushed_epoch,
               n_chars AS stargazers_count, {_LETTERS.format(text='text')} || ',end' AS description,
               lang AS language
        FROM documents
        UNION ALL SELECT source || '/' || doc_id, {_PUSHED}, n_chars, NULL, lang FROM documents""",
    "envelope_rejects": """
        SELECT doc_id, reason
        FROM documents, (VALUES ('malformed'), ('no key'), ('unreadable field')) AS t(reason)""",
    "capture_rejects": """
        SELECT doc_id, reason
        FROM documents, (VALUES ('malformed'), ('no key'), ('unreadable field')) AS t(reason)""",
    "state_fold": """
        SELECT event_type, list_reduce(list(user_id % 1000003 + 1), lambda a, b: a * b % 1000003)
               AS fingerprint
        FROM events WHERE event_type IS NOT NULL GROUP BY event_type""",
    "stream_accepted": f"""
        WITH {_ONCE}
        SELECT doc_id, lang AS language, n_chars AS stargazers_count FROM once""",
    "stream_dashboard": f"""
        WITH {_ONCE}, {_top_words('once')},
        c AS (
          SELECT lang, count(*) AS n, sum(n_chars)::DOUBLE / count(*) AS a FROM once GROUP BY lang
        ),
        newest AS (
          SELECT doc_id // 100 AS batch, lang, id, max(doc_id) AS doc_id FROM repos
          WHERE id IS NOT NULL AND lang IS NOT NULL GROUP BY ALL
        ),
        recent AS (
          SELECT batch, lang, count(*) FILTER (doc_id % 100 >= 39) AS n FROM newest GROUP BY ALL
        ),
        kept AS (
          SELECT * FROM recent
          QUALIFY row_number() OVER (PARTITION BY lang ORDER BY batch DESC) <= 10
        ),
        last AS (SELECT DISTINCT batch FROM kept ORDER BY batch DESC LIMIT 10),
        grid AS (
          SELECT batch, l.lang
          FROM last, (SELECT t.lang FROM {_TRACKED} UNION SELECT lang FROM kept) AS l
        )
        SELECT coalesce(t.lang, c.lang) AS language, 'count' AS item, coalesce(n, 0)::VARCHAR AS value
        FROM {_TRACKED} FULL JOIN c ON c.lang = t.lang
        UNION ALL SELECT coalesce(t.lang, c.lang), 'stars', format('{{:,.4f}}', coalesce(a, 0.0::DOUBLE))
        FROM {_TRACKED} FULL JOIN c ON c.lang = t.lang
        UNION ALL SELECT grid.lang, strftime(to_timestamp(1704067200 + batch * 100 + 99)
          AT TIME ZONE 'UTC', '%H:%M:%S'), coalesce(n, 0)::VARCHAR
        FROM grid LEFT JOIN kept USING (batch, lang)
        UNION ALL SELECT lang, '', {_WORD_LIST} FROM ranked GROUP BY lang""",
}

# A stream over the whole table ends at the result of the batch query.
for _stream, _same in {
    "stream_repo_totals": "repo_totals",
    "stream_avg_stars": "avg_stars",
    "stream_rejected": "rejected_rows",
    "stream_top10_words": "top10_words",
    "stream_top10_sketch": "top10_words",
    "stream_recent": "recent_per_batch",
    "stream_nine_running": "nine_multiples",
    "stream_nine_tumbling": "nine_tumbling_20s",
    "stream_poll_rounds": "poll_dedup",
    "stream_state": "nine_multiples",
    "stream_interval": "nine_multiples",
    "csv_inferred": "csv_roundtrip",
}.items():
    ORACLE[_stream] = ORACLE[_same]
