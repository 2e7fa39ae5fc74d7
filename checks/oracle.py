"""DuckDB SQL for the registered queries, put together from named subqueries.

Patterns are written out here, so that the SQL does not follow the library where that is wrong.
"""

from __future__ import annotations

import re

from . import corpora

_PLAIN = "line"
for _pattern, _to in (
    (r"<!--\s*[^-]*-->", ""),
    (r"<ref[^>]*\/>", ""),
    (r'<ref\s*name="([^"]*)"\s*\/?>[^<]*(<\/ref>)?', ""),
    (r"<ref[^\/]*\/>|<ref[^>]*>[^<]*<\/ref>", ""),
    (r"\[\[Category:([^\]]*)\]\]", r"\1"),
    (r"\[\[[^\]|]*\|([^\]|]*)[^\]]*\]\]", r"\1"),
    (r"\[\[([^\]]*)\]\]", r"\1"),
    (r"\[http://[^\] ]* ([^\]]*)\]", r"\1"),
    (r"\[([^\]]*)\]", r"\1"),
    (r"[']{5}\s*([^']+'[^']+|[^']*)\s*[']{5}", r"\1"),
    (r"[']{3}\s*([^']+'[^']+|[^']*)\s*[']{3}", r"\1"),
    (r"[']{2}\s*([^']+'[^']+|[^']*)\s*[']{2}", r"\1"),
    (r"\{\{([^\}]*)\}\}", ""),
):
    _PLAIN = "regexp_replace({}, '{}', '{}', 'g')".format(_PLAIN, _pattern.replace("'", "''"), _to)


def _shown(prefix: str) -> dict[str, str]:
    """Shown lines of ``<prefix>_text(id, title, text)``."""
    return {
        f"{prefix}_lines": f"""
            SELECT id, unnest(range(len(l))) AS pos, unnest(l) AS line
            FROM (SELECT id, string_split(text, chr(10)) AS l FROM {prefix}_text)""",
        f"{prefix}_depth": f"""
            SELECT id, pos, line, sum(sign((length(line) - length(replace(line, '{{{{', ''))) // 2
                - (length(line) - length(replace(line, '}}}}', ''))) // 2))
                OVER (PARTITION BY id ORDER BY pos) AS depth FROM {prefix}_lines""",
        f"{prefix}_shown": f"""
            SELECT id, pos, line FROM {prefix}_depth WHERE depth = 0 AND line <> ''
              AND NOT starts_with(line, '}}}}') AND NOT starts_with(line, '|')
              AND NOT starts_with(line, '{{') AND NOT starts_with(line, '<')
              AND NOT starts_with(line, '[[File')""",
        f"{prefix}_plain": f"SELECT id, pos, line, {_PLAIN} AS plain FROM {prefix}_shown",
    }


def _words(prefix: str) -> dict[str, str]:
    """Word statistics of ``<prefix>_content(id, content)``, one row per page."""
    return {
        f"{prefix}_tokens": f"""
            SELECT id, unnest(regexp_extract_all(lower(content), '[a-z]+')) AS word
            FROM {prefix}_content""",
        f"{prefix}_postings": f"SELECT word, id, count(*) AS tf FROM {prefix}_tokens GROUP BY word, id",
        f"{prefix}_df": f"SELECT word, count(*) AS df FROM {prefix}_postings GROUP BY word",
        f"{prefix}_stats": f"""
            SELECT id, CAST(coalesce(sum(tf), 0) AS BIGINT) AS n_words, coalesce(max(tf), 0) AS max_tf
            FROM {prefix}_content LEFT JOIN {prefix}_postings USING (id) GROUP BY id""",
        f"{prefix}_terms": """
            SELECT request_id, word, count(*) AS repeats FROM (
              SELECT request_id, unnest(list_filter(string_split(lower(words), ' '),
                lambda x: x <> '')) AS word FROM parsed) GROUP BY ALL""".replace(
            "parsed", f"{prefix}_parsed"
        ),
        f"{prefix}_matches": f"""
            SELECT request_id, word, repeats, df, id, tf FROM {prefix}_terms
            JOIN {prefix}_df USING (word) JOIN {prefix}_postings USING (word)""",
        f"{prefix}_gain": f"""
            SELECT request_id, id, CAST(sum(repeats) AS BIGINT) AS times, min(df) AS min_df,
              CAST(sum(repeats * (CAST(floor(ln(tf) * 1e12 + 0.5) AS BIGINT) + CASE WHEN df = 1 THEN 0
                ELSE CAST(floor(ln(1::DOUBLE / ln(df)) * 1e12 + 0.5) AS BIGINT) END)) AS BIGINT) AS gain
            FROM {prefix}_matches GROUP BY request_id, id""",
        f"{prefix}_scored": _scored(prefix, "n_words"),
        f"{prefix}_scored_max": _scored(prefix, "max_tf"),
    }


def _scored(prefix: str, parts: str) -> str:
    return f"""
        SELECT request_id, id, times, CASE WHEN min_df = 1 THEN 'Infinity'::DOUBLE ELSE
          floor((gain - CAST(floor(ln({parts}) * 1e12 + 0.5) AS BIGINT)) / 1000::DOUBLE + 0.5) / 1e9 END AS ln_score
        FROM {prefix}_gain JOIN {prefix}_stats USING (id)"""


def _results(prefix: str, scored: str) -> str:
    """Full search: resolve, de-duplicate, rank, title hits, merge, cut."""
    return f"""
        SELECT request_id, row_number() OVER (PARTITION BY request_id ORDER BY source, a, b, c) AS rank, id
        FROM (
          SELECT request_id, k, id, source, a, b, c, row_number() OVER (PARTITION BY request_id, id
              ORDER BY source, a, b, c) AS seen, min(source) OVER (PARTITION BY request_id) AS best
          FROM (
            SELECT request_id, result_id AS id, 0 AS source, -times AS a, -ln_score AS b, id AS c
            FROM {scored} JOIN {prefix}_targets USING (id)
            UNION ALL
            SELECT request_id, id, 1, title_rank, 0, id FROM {prefix}_title_hits)
          JOIN {prefix}_parsed USING (request_id))
        WHERE seen = 1 AND best = 0
        QUALIFY rank <= any_value(k) OVER (PARTITION BY request_id)"""


_PARSED = """
    SELECT request_id, abs(n) AS k, CASE WHEN n < 0 THEN 1 ELSE 0 END AS strategy, words FROM (
      SELECT request_id, CAST(string_split(trim(msg), ' ')[1] AS BIGINT) AS n,
        substr(trim(msg), strpos(trim(msg), ' ') + 1) AS words FROM ({}))"""

NAMED = {
    # The dump of documents.
    "w_raw": corpora.WIKI_DUMP,
    "w_fields": r"""
        SELECT TRY_CAST(regexp_extract(raw, '(?s)<id>(.*?)</id>', 1) AS BIGINT) AS id,
          regexp_extract(raw, '(?s)<title>(.*?)</title>', 1) AS title,
          regexp_extract(raw, '<redirect[^>]*title="([^"]*)"', 1) AS redirect_title,
          regexp_extract(raw, '(?s)<sha1>(.*)</sha1>', 1) AS sha1,
          regexp_extract(raw, '(?s)<text[^>]*>(.*)</text>', 1) AS text FROM w_raw""",
    "w_pages": """
        SELECT * FROM w_fields WHERE text <> '' AND sha1 <> 't5mm8lyj25cvxe8i4i9pgokb6krbzj9'
          AND id IS NOT NULL""",
    "w_text": """
        SELECT id, title, replace(replace(replace(replace(replace(text, '&quot;', '"'), '&amp;', '&'),
          '&lt;', '<'), '&gt;', '>'), '&nbsp;', ' ') AS text FROM w_pages""",
    **_shown("w"),
    "w_content": """
        SELECT w_text.id, replace(replace(replace(replace(replace(title, '&quot;', '"'), '&amp;', '&'), '&lt;', '<'), '&gt;', '>'), '&nbsp;', ' ') || ' ' || coalesce(string_agg(plain, chr(10) ORDER BY pos), '') AS content
        FROM w_text LEFT JOIN w_plain ON w_plain.id = w_text.id GROUP BY w_text.id, title""",
    "w_parsed": _PARSED.format(corpora.REQUESTS),
    **_words("w"),
    "w_directory": r"""
        SELECT DISTINCT id, title, lower(regexp_replace(title, '[^\x00-\x7F]', ' ', 'g')) AS title_norm
        FROM w_pages""",
    "w_title_ids": """
        SELECT title_norm, CAST(min(CAST(id AS VARCHAR)) AS BIGINT) AS result_id
        FROM w_directory GROUP BY title_norm""",
    "w_targets": r"""
        SELECT id, id AS result_id FROM w_stats WHERE n_words >= 100
        UNION ALL
        SELECT id, result_id FROM w_stats JOIN w_pages USING (id) JOIN w_title_ids
          ON title_norm = lower(regexp_replace(redirect_title, '[^\x00-\x7F]', ' ', 'g'))
        WHERE n_words < 100 AND redirect_title <> ''""",
    "w_title_hits": r"""
        SELECT request_id, id, row_number() OVER (PARTITION BY request_id ORDER BY CAST(id AS VARCHAR))
          AS title_rank
        FROM w_parsed JOIN w_directory
          ON starts_with(title_norm, lower(regexp_replace(words, '[^\x00-\x7F]', ' ', 'g')))
        WHERE words <> ''
        QUALIFY title_rank <= k""",
    "w_results": _results("w", "w_scored"),
    # Plain documents, no title.
    "d_content": "SELECT doc_id AS id, text AS content FROM documents",
    "d_parsed": _PARSED.format(corpora.TEXT_REQUESTS),
    **_words("d"),
    # Documents with markup.
    "m_text": corpora.MARKUP_PAGES,
    **_shown("m"),
    "m_cites": r"""
        SELECT row_number() OVER () AS n, id, string_split(body, '|')[1] AS type,
          string_split(body, '|')[2:] AS parts
        FROM (SELECT id, unnest(regexp_extract_all(line, '(?i)\{\{Cite\s*([^\}]*)\}\}', 1)) AS body
          FROM m_shown)""",
    "m_cite_values": """
        SELECT n, nth, string_split(part, '=')[1] AS key, coalesce(string_split(part, '=')[2], '') AS value
        FROM (SELECT n, unnest(range(len(parts))) AS nth, unnest(parts) AS part FROM m_cites)""",
    "m_abstracts": r"""
        SELECT id, coalesce(arg_min(plain, pos), '') AS abstract FROM m_text LEFT JOIN (
          SELECT * FROM m_plain WHERE NOT regexp_matches(line, '^(\*|\[\*[^\]]*\])')
            AND NOT starts_with(line, '=')) p USING (id) GROUP BY id""",
    # HTML pages.
    "p_titles": r"""
        SELECT page_id AS id, regexp_extract(html, '(?s)<title>(.*?)</title>', 1) AS title FROM pages""",
}


def sql(final: str) -> str:
    """``final`` with the named subqueries it needs."""
    order: list[str] = []

    def need(text: str) -> None:
        for name in dict.fromkeys(re.findall(r"\b[dwmp]_[a-z_]+\b", text)):
            if name in NAMED and name not in order:
                need(NAMED[name])
                order.append(name)

    need(final)
    if not order:
        return final
    return "WITH " + ",\n".join(f"{n} AS MATERIALIZED ({NAMED[n]})" for n in order) + "\n" + final


def _found(pattern: str, columns: str, where: str = "true", group: int = 1) -> str:
    p = pattern.replace("'", "''")
    return f"""SELECT id, {columns} FROM (
        SELECT id, unnest(regexp_extract_all(line, '{p}', {group})) AS body FROM m_shown) WHERE {where}"""


_FIELDS = "id, title, redirect_title, sha1, text"

_FINAL = {
    # 2.1 sources and sinks
    "load_dump": "SELECT raw FROM w_raw",
    "load_dump_offsets": """SELECT TRY_CAST(regexp_extract(raw, '(?s)<id>(.*?)</id>', 1) AS BIGINT) AS id,
        CAST(strlen(raw) AS INTEGER) AS n_bytes, true AS placed FROM w_raw""",
    "load_tag_records": "SELECT '<title>' || title || '</title>' AS raw FROM w_fields",
    "multi_path_scan": f"SELECT raw FROM w_raw UNION ALL ({corpora.HTML_DUMP})",
    "export_tsv": "SELECT word || ' ' || id || chr(9) || tf AS value FROM d_postings",
    "write_index": "SELECT word, df FROM d_df",
    "load_index": """
        SELECT word, id, tf, n_words, max_tf, CASE WHEN n_words >= 100 THEN id END AS result_id
        FROM d_postings JOIN d_stats USING (id)""",
    # 2.2 projections and text functions
    "tag_slice_greedy": "SELECT page_id, regexp_extract(html, '(?s)<p[^>]*>(.*)</p>', 1) AS slice FROM pages",
    "tag_slice_first": "SELECT page_id, regexp_extract(html, '(?s)<article[^>]*>(.*?)</article>', 1) AS slice FROM pages",
    "tag_slice_exact": """SELECT page_id, regexp_extract(html, '(?s)<html lang="en">(.*?)</html>', 1) AS slice FROM pages""",
    "title_cut": "SELECT title FROM p_titles",
    "page_fields": f"SELECT {_FIELDS} FROM w_fields",
    "redirect_title": "SELECT id, redirect_title FROM w_fields",
    "is_redirect_text": "SELECT id, starts_with(text, '#REDIRECT') AS is_redirect FROM w_fields",
    "entity_decode": """SELECT page_id, replace(replace(replace(replace(replace(html, '&quot;', '"'),
        '&amp;', '&'), '&lt;', '<'), '&gt;', '>'), '&nbsp;', ' ') AS html FROM pages""",
    "clean_text": "SELECT id, content FROM w_content",
    "normalise_letters": """SELECT doc_id, regexp_replace(lower(text), '[^a-z]', ' ', 'g') AS letters
        FROM documents""",
    "tokenize": """SELECT doc_id, array_to_string(regexp_extract_all(lower(text), '[a-z]+'), ' ') AS tokens
        FROM documents""",
    "title_normalise": r"""SELECT id, lower(regexp_replace(title, '[^\x00-\x7F]', ' ', 'g')) AS title_norm
        FROM p_titles""",
    "parse_request": "SELECT request_id, k, strategy, words FROM w_parsed",
    "query_terms": """
        SELECT request_id, unnest(range(len(t))) AS pos, unnest(t) AS word FROM (SELECT request_id,
          list_filter(string_split(lower(words), ' '), lambda x: x <> '') AS t FROM w_parsed)""",
    # 2.3 filters
    "drop_empty_text": f"SELECT {_FIELDS} FROM w_fields WHERE text <> ''",
    "drop_blocked_sha1": f"SELECT {_FIELDS} FROM w_fields WHERE sha1 <> 't5mm8lyj25cvxe8i4i9pgokb6krbzj9'",
    "drop_missing_id": """SELECT TRY_CAST(regexp_extract(url, '/([0-9]+)$', 1) AS BIGINT) AS id, url FROM pages
        WHERE TRY_CAST(regexp_extract(url, '/([0-9]+)$', 1) AS BIGINT) IS NOT NULL""",
    "indexable_pages": f"SELECT {_FIELDS} FROM w_pages",
    "min_words_filter": "SELECT id, n_words, max_tf FROM d_stats WHERE n_words >= 100",
    # 2.4 aggregations
    "word_count": "SELECT word, count(*) AS n FROM d_tokens GROUP BY word HAVING count(*) > 1",
    "page_word_count": "SELECT id, n_words FROM d_stats",
    "page_max_word_count": "SELECT id, max_tf FROM d_stats",
    "inverted_index": "SELECT word, id, tf FROM d_postings",
    "document_frequency": "SELECT word, df FROM d_df",
    "posting_lists": """
        SELECT word, id // 10000 AS part,
          word || ' ' || string_agg(id || ' ' || tf, ' ' ORDER BY CAST(id AS VARCHAR)) AS line
        FROM d_postings GROUP BY 1, 2""",
    "page_directory": "SELECT id, title, title_norm FROM w_directory",
    "title_list": "SELECT DISTINCT title FROM p_titles",
    "duplicate_titles": "SELECT title, count(*) AS n FROM p_titles GROUP BY title HAVING count(*) > 1",
    "redirect_count": """SELECT 'Answer' AS answer, count(*) AS n FROM w_fields
        WHERE starts_with(text, '#REDIRECT') AND sha1 <> 't5mm8lyj25cvxe8i4i9pgokb6krbzj9'""",
    "bad_doc_count": "SELECT 'Answer' AS answer, count(*) AS n FROM w_fields WHERE text = ''",
    # 2.5 joins and ranked retrieval
    "term_lookup": "SELECT request_id, word, repeats, df, id, tf FROM d_matches",
    "term_weight": """SELECT word, df, CASE WHEN df = 1 THEN 'Infinity'::DOUBLE
        ELSE round(1 / ln(df), 9) END AS weight FROM d_df""",
    "score_by_length": "SELECT request_id, id, times, ln_score FROM d_scored",
    "score_by_max_tf": "SELECT request_id, id, times, ln_score FROM d_scored_max",
    "redirect_resolve": "SELECT request_id, id, result_id, times, ln_score FROM w_scored JOIN w_targets USING (id)",
    "title_prefix_search": """
        SELECT request_id, title_rank, id FROM w_title_hits""",
    "title_lookup": """
        SELECT redirect_title AS title, result_id AS id FROM (SELECT DISTINCT redirect_title FROM w_pages
          WHERE redirect_title <> '') JOIN w_title_ids ON title_norm = lower(redirect_title)""",
    "fetch_pages": """SELECT request_id, rank, id, w_text.title, sha1, w_text.text FROM w_results
        JOIN w_text USING (id) JOIN w_pages USING (id)""",
    "search": """
        SELECT row_number() OVER (ORDER BY times DESC, ln_score DESC, id) AS rank, id FROM (
          SELECT id, count(*) AS times, CASE WHEN min(df) = 1 THEN 'Infinity'::DOUBLE ELSE
            floor((CAST(sum(CAST(floor(ln(tf) * 1e12 + 0.5) AS BIGINT)
              + CAST(floor(ln(1::DOUBLE / ln(df)) * 1e12 + 0.5) AS BIGINT)) AS BIGINT)
              - CAST(floor(ln(any_value(n_words)) * 1e12 + 0.5) AS BIGINT)) / 1000::DOUBLE + 0.5) / 1e9 END AS ln_score
          FROM d_postings JOIN d_df USING (word) JOIN d_stats USING (id)
          WHERE word IN ('the', 'heat', 'tion') AND n_words >= 100 GROUP BY id)
        QUALIFY rank <= 10""",
    "search_batch": "SELECT request_id, rank, id FROM w_results",
    # 2.6 markup
    "visible_lines": "SELECT id, pos, line FROM m_shown",
    "plain_text": "SELECT id, pos, plain FROM m_plain",
    "classify_lines": r"""SELECT id, pos, CASE WHEN regexp_matches(line, '^(\*|\[\*[^\]]*\])') THEN 'item'
        WHEN starts_with(line, '=') THEN 'heading' ELSE 'paragraph' END AS kind, plain FROM m_plain""",
    "headings": """
        SELECT id, pos, level, substring(line, level + 1, greatest(length(line) - 2 * level, 0)) AS heading
        FROM (SELECT *, length(regexp_extract(line, '^(=+)[^=]', 1)) AS level FROM m_shown) WHERE level > 0""",
    "page_links": _found(
        r"\[\[([^\]]*)\]\]",
        r"""regexp_replace(string_split(body, '|')[1], '\s', '_', 'g') AS target,
        coalesce(string_split(body, '|')[2], body) AS label""",
        "NOT starts_with(body, 'Category:')",
    ),
    "page_categories": _found(
        r"\[\[([^\]]*)\]\]", "substr(body, 10) AS category", "starts_with(body, 'Category:')"
    ),
    "external_links": _found(
        r"\[([^\]]*)\]",
        "substr(body, 1, greatest(strpos(body, ' ') - 1, 0)) AS url, substr(body, strpos(body, ' ') + 1) AS title",
        "starts_with(body, 'http://')",
    ),
    "citations": """
        SELECT id, type, coalesce(t.value, '') AS title, coalesce(v.key, '') AS key,
          coalesce(v.value, '') AS value
        FROM m_cites LEFT JOIN (SELECT n, arg_max(value, nth) AS value FROM m_cite_values
            WHERE key = 'title' GROUP BY n) t USING (n)
          LEFT JOIN (SELECT n, key, arg_max(value, nth) AS value FROM m_cite_values
            WHERE key <> 'title' GROUP BY n, key) v USING (n)""",
    "library_refs": r"""
        SELECT id, 'gutenberg' AS kind,
          coalesce(regexp_extract(last_no, '^no=([^=]*)', 1), '') AS key,
          coalesce(regexp_extract(last_name, '^name=([^=]*)', 1), '') AS title,
          'http://www.gutenberg.org/ebooks/' || key AS url
        FROM (SELECT id, coalesce(list_filter(s, lambda x: starts_with(x, 'no='))[-1], 'no=0') AS last_no,
            list_filter(s, lambda x: starts_with(x, 'name='))[-1] AS last_name
          FROM (SELECT id, string_split(unnest(regexp_extract_all(line,
            '(?i)\{\{Gutenberg\s*([^\}]*)\}\}', 1)), '|')[2:] AS s FROM m_shown))
        UNION ALL
        SELECT id, 'worldcat', substr(body, strpos(body, 'id=') + 3), 'Worldcat reference',
          'http://www.worldcat.org/identities/' || substr(body, strpos(body, 'id=') + 3)
        FROM (SELECT id, unnest(regexp_extract_all(line, '(?i)\{\{worldcat\s*([^\}]*)\}\}', 1)) AS body
          FROM m_shown)""",
    "language_notes": r"""
        SELECT id, template, language, CASE WHEN language IS NULL THEN '[' || words || ']'
          ELSE language || ': ' || words END AS note
        FROM (SELECT id, p[1] AS template, CASE p[1] WHEN 'lang-fr' THEN 'French' WHEN 'lang-es' THEN 'Spanish'
            WHEN 'lang-en' THEN 'English' WHEN 'lang-it' THEN 'Italian' END AS language,
            coalesce(array_to_string(list_filter(p[2:], lambda x: NOT regexp_matches(x, 'links|IPA|icon')), ''), '')
              AS words
          FROM (SELECT id, string_split(body, '|') AS p FROM (
            SELECT id, unnest(regexp_extract_all(line, '\{\{([^\}]*)\}\}', 1)) AS body FROM m_shown)
            WHERE NOT regexp_matches(body, '(?i)^(cite|gutenberg|worldcat)'))
          WHERE NOT contains(p[1], 'cite'))""",
    "named_refs": r"""SELECT id, name FROM (SELECT id, unnest(regexp_extract_all(line,
        '<ref\s*name="([^"]*)"\s*\/?>[^<]*(<\/ref>)?', 1)) AS name FROM m_shown)""",
    "abstracts": "SELECT id, abstract FROM m_abstracts",
    # 2.7 windows, sorting, sets
    "rank_pages": """
        SELECT request_id, row_number() OVER (PARTITION BY request_id ORDER BY times DESC, ln_score DESC, id)
          AS rank, id, times, ln_score FROM d_scored QUALIFY rank <= 20""",
    "top_k": """
        SELECT request_id, row_number() OVER (PARTITION BY request_id ORDER BY times DESC, ln_score DESC, id)
          AS rank, id FROM d_scored JOIN d_stats USING (id) JOIN d_parsed USING (request_id)
        WHERE n_words >= 100 QUALIFY rank <= k""",
    "terms_by_df": "SELECT request_id, word, repeats, df FROM d_terms JOIN d_df USING (word)",
    "merge_results": """
        SELECT request_id, id, min(source) AS source FROM (
          SELECT request_id, result_id AS id, 0 AS source FROM w_scored JOIN w_targets USING (id)
          UNION ALL SELECT request_id, id, 1 FROM w_title_hits) GROUP BY request_id, id""",
    "dedup_results": """
        SELECT request_id, result_id AS id, times, ln_score, id AS hit
        FROM w_scored JOIN w_targets USING (id) QUALIFY row_number() OVER (
          PARTITION BY request_id, result_id ORDER BY times DESC, ln_score DESC, id) = 1""",
    "sorted_index": "SELECT word, id, tf FROM w_postings",
}
_FINAL["search_stream"] = _FINAL["search_batch"]
_FINAL["result_list"] = """
    SELECT request_id, rank, id, title, abstract FROM w_results JOIN w_text USING (id) JOIN (
      SELECT w_text.id, coalesce(arg_min(plain, pos), '') AS abstract FROM w_text LEFT JOIN (
        SELECT * FROM w_plain WHERE NOT regexp_matches(line, '^(\\*|\\[\\*[^\\]]*\\])')
          AND NOT starts_with(line, '=')) p ON p.id = w_text.id GROUP BY w_text.id) a USING (id)"""


def oracle_sql() -> dict[str, str]:
    return {key: sql(final) for key, final in _FINAL.items()}
