"""Page search on Spark: corpus statistics, an inverted index, ranked keyword search."""

from .functions.markup import plain_text
from .functions.text import (
    entity_decode,
    is_redirect_text,
    normalise_letters,
    redirect_title,
    tag_slice_exact,
    tag_slice_first,
    tag_slice_greedy,
    title_cut,
    title_normalise,
    tokenize,
)
from .operators.filters import (
    drop_blocked_sha1,
    drop_empty_text,
    drop_missing_id,
    indexable_pages,
    min_words_filter,
)
from .operators.lines import (
    abstracts,
    citations,
    classify_lines,
    external_links,
    headings,
    language_notes,
    library_refs,
    named_refs,
    page_categories,
    page_links,
    plain_lines,
    visible_lines,
)
from .operators.pages import bad_doc_count, clean_text, page_fields, redirect_count
from .operators.ranking import (
    dedup_results,
    merge_results,
    parse_request,
    query_terms,
    rank_pages,
    redirect_resolve,
    score_by_length,
    score_by_max_tf,
    term_lookup,
    term_weight,
    terms_by_df,
    top_k,
)
from .operators.titles import (
    duplicate_titles,
    fetch_pages,
    page_directory,
    page_targets,
    title_list,
    title_lookup,
    title_prefix_search,
)
from .operators.words import (
    document_frequency,
    inverted_index,
    page_max_word_count,
    page_word_count,
    posting_lists,
    sorted_index,
    word_count,
)
from .plans.build import index_dump, indexed_pages, load_pages
from .plans.search import result_list, search, search_batch
from .sources.dump import load_dump, load_dump_offsets, load_tag_records, multi_path_scan
from .sources.export import export_tsv
from .sources.index_store import Index, load_index, write_index
from .streaming.requests import read_requests, search_stream
