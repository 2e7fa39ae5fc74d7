"""Corpora derived from the test tables, as SQL that Spark and DuckDB read alike."""

from __future__ import annotations

#: Dump records of ``documents``: redirects, pages without text, a blocked checksum and
#: titles that two pages share.
WIKI_DUMP = """
SELECT '<page><title>' || title || '</title><ns>0</ns><id>' || CAST(doc_id AS varchar(20)) || '</id>'
    || CASE WHEN is_redir THEN '<redirect title="' || target || '" />' ELSE '' END
    || '<revision><id>' || CAST(doc_id + 1000000 AS varchar(20)) || '</id>'
    || CASE WHEN doc_id % 97 = 5 THEN '<text xml:space="preserve" />'
            WHEN is_redir THEN '<text xml:space="preserve">#REDIRECT [[' || target || ']]</text>'
            ELSE '<text xml:space="preserve">'
              || replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') || '</text>' END
    || '<sha1>' || CASE WHEN doc_id % 101 = 7 THEN 't5mm8lyj25cvxe8i4i9pgokb6krbzj9'
                        ELSE md5(text) END || '</sha1></revision></page>' AS raw
FROM (SELECT doc_id, text,
         'Doc ' || upper(lang) || ' ' || CAST(doc_id - doc_id % 2 AS varchar(20)) AS title,
         doc_id % 10 = 3 AS is_redir,
         'Doc ' || upper(lang) || ' ' || CAST(doc_id + 1 - (doc_id + 1) % 2 AS varchar(20)) AS target
  FROM documents) b
"""

#: Dump records of ``pages``: the whole HTML as text.
HTML_DUMP = """
SELECT '<page><title>' || url || '</title><id>' || CAST(page_id AS varchar(20)) || '</id><text>'
    || replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') || '</text></page>' AS raw
FROM (SELECT page_id, replace(url, '&', '&amp;') AS url, html FROM pages) b
"""

#: ``documents`` with markup around and inside the whole text.
MARKUP_PAGES = """
SELECT doc_id AS id, 'Doc ' || upper(lang) || ' ' || CAST(doc_id AS varchar(20)) AS title,
    '{{Infobox page' || nl || '| lang = ' || lang || nl || '| source = ' || source || nl || '}}' || nl
    || CASE WHEN n_chars % 5 = 0 THEN '' ELSE q || q || q || source || q || q || q
        || ' in {{lang-fr|' || lang || '|links=no}} {{IPA note|' || source || '|icon}} {{stub}}, '
        || '[http://example.org/doc/' || CAST(doc_id AS varchar(20)) || ' Copy ' || source || '] '
        || '[http://example.org/bare] [see ' || source || ']<ref name="S' || source || '">z</ref>'
        || '<ref>q</ref><!-- n ' || CAST(n_chars AS varchar(20)) || ' -->' || nl END
    || '== ' || source || ' text ==' || nl
    || replace(replace(replace(text, ' the ', ' [[The word|the]] '),
                       ' and ', ' ' || q || q || 'and' || q || q || ' '), '. ', '.' || nl || '* ') || nl
    || CASE WHEN n_chars % 7 = 0 THEN '}}' || nl ELSE '' END
    || '{{Note ' || nl || 'inside {{x}} a block of ' || lang || nl || '}} left' || nl
    || '=== Sources ' || CAST(n_chars AS varchar(20)) || ' ===' || nl || '=Open' || nl || '====' || nl
    || '* {{Cite web|title=T' || CAST(doc_id AS varchar(20)) || '|url=http://x/?a=' || source
        || '|url=http://y/' || lang || '|note}} {{cite book|title=Book of ' || lang || '}}' || nl
    || '* {{Gutenberg|no=' || CAST(n_chars AS varchar(20)) || '|name=Book ' || source
        || '}} {{worldcat id|id=lccn-' || CAST(doc_id AS varchar(20)) || '}} {{gutenberg|name=N}}' || nl
    || '[* ' || lang || ' in brackets]' || nl || '[[File:x.png]]' || nl || '<div>' || nl
    || '[[Category:Lang ' || lang || ']] [[Category:' || source || ']] [[Other page]]' AS text
FROM (SELECT *, chr(10) AS nl, chr(39) AS q FROM documents) b
"""

#: Requests with the words of ``benchmark`` texts, every text twice with different limits.
TEXT_REQUESTS = """
SELECT 2 * item_id + copy AS request_id,
    CASE WHEN item_id % 2 = 0 THEN '-' ELSE '' END || CAST(3 + item_id % 10 - 2 * copy AS varchar(20))
    || ' ' || replace(text, chr(10), ' ') AS msg
FROM (SELECT item_id, text, 0 AS copy FROM benchmark
      UNION ALL SELECT item_id, text, 1 AS copy FROM benchmark) c
"""

#: Requests that begin titles of the dump.
TITLE_REQUESTS = """
SELECT 1000000 + min(doc_id) AS request_id,
    '12 Doc ' || upper(lang) || ' ' || CAST(doc_id % 10 AS varchar(20)) AS msg
FROM documents GROUP BY lang, doc_id % 10
"""

REQUESTS = TEXT_REQUESTS + " UNION ALL " + TITLE_REQUESTS
