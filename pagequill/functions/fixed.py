"""Tags, patterns, names and addresses that results depend on."""

PAGE_START = "<page>"
PAGE_END = "</page>"

TEXT_OPEN, TEXT_CLOSE = "<text", "</text>"
ID_OPEN, ID_CLOSE = "<id>", "</id>"
TITLE_OPEN, TITLE_CLOSE = "<title>", "</title>"
SHA1_OPEN, SHA1_CLOSE = "<sha1>", "</sha1>"
REDIRECT_TITLE = r'<redirect[^>]*title="([^"]*)"'
REDIRECT_TEXT = "#REDIRECT"

# Checksums of pages that are never indexed.
BLOCKED_SHA1 = ("t5mm8lyj25cvxe8i4i9pgokb6krbzj9",)

# Pages with fewer words are not returned themselves.
MIN_WORDS = 100

# Entities in the order in which they are decoded.
ENTITIES = (
    ("&quot;", '"'),
    ("&amp;", "&"),
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&nbsp;", " "),
)

# Lines that begin with one of these never reach the reader.
HIDDEN_LINE_STARTS = ("}}", "|", "{", "<", "[[File")

# Inline markup.
STRONG_EM = r"[']{5}\s*([^']+'[^']+|[^']*)\s*[']{5}"
STRONG = r"[']{3}\s*([^']+'[^']+|[^']*)\s*[']{3}"
EM = r"[']{2}\s*([^']+'[^']+|[^']*)\s*[']{2}"
LINK = r"\[\[([^\]]*)\]\]"
BRACKET = r"\[([^\]]*)\]"
COMMENT = r"<!--\s*[^-]*-->"
TEMPLATE = r"\{\{([^\}]*)\}\}"
NAMED_REF = r'<ref\s*name="([^"]*)"\s*\/?>[^<]*(<\/ref>)?'
ANY_REF = r"<ref[^\/]*\/>|<ref[^>]*>[^<]*<\/ref>"
CITE = r"(?i)\{\{Cite\s*([^\}]*)\}\}"
GUTENBERG = r"(?i)\{\{Gutenberg\s*([^\}]*)\}\}"
WORLDCAT = r"(?i)\{\{worldcat\s*([^\}]*)\}\}"

CATEGORY_PREFIX = "Category:"
EXTERNAL_PREFIX = "http://"
GUTENBERG_URL = "http://www.gutenberg.org/ebooks/"
WORLDCAT_URL = "http://www.worldcat.org/identities/"
WORLDCAT_TITLE = "Worldcat reference"
LANGUAGES = {
    "lang-fr": "French",
    "lang-es": "Spanish",
    "lang-en": "English",
    "lang-it": "Italian",
}
SKIPPED_LANGUAGE_PARTS = "links|IPA|icon"
