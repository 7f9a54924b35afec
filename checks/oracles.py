"""The queries once more, as SQL for DuckDB."""

from __future__ import annotations

from .views import DATASETS, STEADY, sql_over

CHANGES = "array_to_string(coalesce(change_types, []), ',') as change_types"
FLAT = f"lin, path, file_type, s2, {CHANGES}"
FEED = f"path, s2 as snapshot, {CHANGES}"
REGULAR = "file_type = 'regular'"
ENGLISH = f"{REGULAR} and starts_with(path, '/ifs/data/en')"
EVERYTHING = f"{REGULAR} and starts_with(path, '/ifs/data')"
UP_TO_LATEST = "s2 <= (select max(s2) from file_index)"
HAS = "list_contains(coalesce(change_types, []), '{}')"
ADDED = HAS.format("ENTRY_ADDED")
DELETED = HAS.format("ENTRY_DELETED")


def over_index(columns: str, condition: str) -> str:
    return sql_over("file_index", body=f"select {columns} from file_index where {condition}")


def over_paths(condition: str) -> str:
    return sql_over(
        "path_variants", body=f"select lin, path from path_variants where {condition}"
    )


def over_feed(content_view: str, select: str) -> str:
    """A query over the full feed and the files on storage."""
    return sql_over(
        "file_index",
        content_view,
        body=f"""
        , feed as (select {FEED} from file_index where {EVERYTHING} and s2 > -1 and {UP_TO_LATEST})
        {select}""".lstrip(),
    )


def last_of(number: int, app: str, kind: str, scope: str, version: int) -> str:
    return f"""
        select {number} as key_no, '{kind}' as kind,
               coalesce(max(snapshot), -1)::bigint as snapshot
        from commit_log
        where app = '{app}' and kind = '{kind}' and scope = '{scope}' and version = {version}"""


DELETED_ONLY = "(list_contains(string_split(change_types, ','), 'ENTRY_DELETED') and not list_contains(string_split(change_types, ','), 'ENTRY_ADDED'))"

DOCUMENTS = """
    select content as page_content, path as source, snapshot, change_types
    from feed join file_content using (path)"""

ELEMENTS = """
    , lines as (
        select path, snapshot, change_types, string_split(content, chr(10)) as lines
        from feed join file_content using (path)),
    numbered as (
        select path, snapshot, change_types,
               unnest(range(len(lines))) as line_no, unnest(lines) as line
        from lines),
    trimmed as (
        select path, snapshot, change_types, line_no,
               trim(line, ' ' || chr(9) || chr(10) || chr(13)) as line
        from numbered),
    elements as (
        select line as page_content, path as source, snapshot, change_types,
               case when regexp_matches(line, '^([-*]|[0-9]+[.]) ') then 'ListItem'
                    when length(line) <= 80 and not suffix(line, '.') then 'Title'
                    else 'NarrativeText' end as category,
               line_no::integer as element_no
        from trimmed where line <> '')
    """

OUTCOMES = """
    select path, snapshot, content is not null as ok,
           case when stored_files.path is null then 'missing'
                when content is null then 'unreadable' end as error
    from feed left join stored_files using (path)"""


def chunks(size: int, overlap: int, max_chars: int, of_feed: bool = False) -> str:
    stride = size - overlap
    texts = "(select path, content from feed join file_content using (path))" if of_feed else "file_content"
    over = over_feed if of_feed else lambda name, body: sql_over(name, body=body)
    return over(
        "file_content",
        f"""
        , words as (
            select path,
                   list_filter(regexp_split_to_array(content, '[ \\t\\n\\r]+'),
                               lambda w: w <> '') as words
            from {texts}),
        starts as (
            select path, words,
                   unnest(range(1 + greatest(0, ceil((len(words) - {size}) / {stride}))::bigint))
                       as chunk_no
            from words where len(words) > 0),
        whole as (
            select path, chunk_no,
                   array_to_string(
                       words[chunk_no * {stride} + 1 : chunk_no * {stride} + {size}], ' ') as chunk
            from starts),
        pieces as (
            select path, chunk_no, chunk,
                   unnest(range(ceil(length(chunk) / {max_chars})::bigint)) as piece_no
            from whole)
        select path, chunk_no::integer as chunk_no, piece_no::integer as piece_no,
               substring(chunk, piece_no * {max_chars} + 1, {max_chars}) as chunk
        from pieces""".lstrip(),
    )


PAGE_TEXT = """
    select page_id, url,
           trim(regexp_replace(
               replace(replace(replace(replace(replace(replace(
                   regexp_replace(regexp_replace(regexp_replace(regexp_replace(html,
                       '(?s)<script[^>]*>.*?</script>', ' ', 'g'),
                       '(?s)<style[^>]*>.*?</style>', ' ', 'g'),
                       '(?s)<!--.*?-->', ' ', 'g'),
                       '(?s)<[^>]*>', ' ', 'g'),
                   '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', chr(39)),
                   '&nbsp;', ' '), '&amp;', '&'),
               '[ \\t\\n\\r]+', ' ', 'g')) as text
    from pages"""


ORACLES = {
    "index_scan": over_index(FLAT, "true"),
    "index_scan_json": over_index(FLAT, "true"),
    "index_layout": over_index(FEED, f"{ENGLISH} and s2 > 9 and {UP_TO_LATEST}"),
    "regular_files": over_index(FLAT, REGULAR),
    "folder_prefix": over_paths("starts_with(path, '/ifs/data')"),
    "folder_subtree": over_paths("path = '/ifs/data' or starts_with(path, '/ifs/data/')"),
    "folder_phrase": over_paths("contains(path, '/ifs/data')"),
    "scan_scope": over_index(FLAT, ENGLISH),
    "dataset_scope": over_index(
        FEED, f"{REGULAR} and {DATASETS['en_or_de']} and s2 > -1 and {UP_TO_LATEST}"
    ),
    "in_dataset": over_index(FLAT, DATASETS["not_src1"]),
    "changed_between": over_index(FLAT, "s2 > 3 and s2 <= 8"),
    "latest_snapshot": sql_over(
        "file_index", body="select coalesce(max(s2), -1)::bigint as snapshot from file_index"
    ),
    "last_snapshot": sql_over(
        "commit_log",
        body=" union all ".join(
            [
                last_of(0, "app_1", "folder_paths", "/ifs/data/error", 1),
                last_of(1, "app_1", "folder_paths", "/ifs/data/error", 2),
                last_of(2, "app_1", "datasets", "/ifs/data/error", 1),
            ]
        ),
    ),
    "current_checkpoints": sql_over(
        "commit_log",
        body="""
        select app, kind, scope, version, max(snapshot) as snapshot
        from commit_log group by app, kind, scope, version""",
    ),
    "checkpoint_commit": sql_over(
        "file_index",
        body="""
        select 'app_a' as app, 'folder_paths' as kind, scope, 1 as version,
               (select max(s2) from file_index) as snapshot
        from (select distinct '/ifs/data/' || lang as scope from documents)
        union all select 'app_a', 'folder_paths', '/ifs/data/en', 2, 2""",
    ),
    "checkpoint_modes": sql_over(
        "mode_index",
        body=" union all ".join(
            f"select '{mode}' as mode, {FEED} from mode_index where {condition}"
            for mode, condition in (
                ("prefix", "starts_with(path, '/ifs/data')"),
                ("subtree", "starts_with(path, '/ifs/data/')"),
                ("phrase", "contains(path, '/ifs/data')"),
            )
        ),
    ),
    "changes_first_run": over_index(FEED, f"{ENGLISH} and s2 > -1 and {UP_TO_LATEST}"),
    "changes_incremental": over_index(FEED, f"{ENGLISH} and s2 > 9 and {UP_TO_LATEST}"),
    "changes_forced": over_index(FEED, f"{ENGLISH} and s2 > 0 and {UP_TO_LATEST}"),
    "changes_since": over_index(FEED, f"{ENGLISH} and s2 > 4 and {UP_TO_LATEST}"),
    "new_files": over_index(
        "path, s2 as snapshot", f"{ENGLISH} and s2 > 9 and {UP_TO_LATEST} and {ADDED}"
    ),
    "deleted_files": over_index(
        "path, s2 as snapshot", f"{ENGLISH} and s2 > 9 and {UP_TO_LATEST} and {DELETED}"
    ),
    "all_files": over_index(
        "path, s2 as snapshot", f"{EVERYTHING} and s2 > 0 and {UP_TO_LATEST} and {ADDED}"
    ),
    "run_all_files": over_index(
        "path, s2 as snapshot", f"{ENGLISH} and s2 > 0 and {UP_TO_LATEST} and {ADDED}"
    ),
    "document_feed": over_index(
        f"'' as page_content, path as source, s2 as snapshot, {CHANGES}",
        f"{ENGLISH} and s2 > -1 and {UP_TO_LATEST}",
    ),
    "page_after": over_index(
        FLAT, f"{EVERYTHING} and (lin, path) > (100, '/ifs/data') order by lin, path limit 500"
    ),
    "page_walk": sql_over(
        "gap_index",
        body=f"""
        , numbered as (
            select *, row_number() over (order by lin nulls first, path nulls first) - 1 as position,
                   (count(*) over () + 3) // 4 as size
            from gap_index)
        select {FLAT}, (position // size)::integer as page from numbered""".lstrip(),
    ),
    "number_pages": sql_over(
        "file_index",
        body=f"""
        , numbered as (
            select *, row_number() over (order by lin, path) - 1 as position
            from file_index where {EVERYTHING})
        select {FLAT}, position, position // 100 as page from numbered""".lstrip(),
    ),
    "load_documents": over_feed("file_content", DOCUMENTS),
    "load_wide_feed": over_feed(
        "file_content",
        "select path, snapshot, upper(path) as name, snapshot as first, content "
        "from feed join file_content using (path)",
    ),
    "loaded_outcomes": over_feed(
        "stored_files",
        OUTCOMES.replace("content is not null as ok,", "content is not null as ok, length(content) as n_chars,"),
    ),
    "open_files": over_feed("file_content", DOCUMENTS),
    "bucketed_content": over_feed("file_content", DOCUMENTS),
    "packed_files": over_feed(
        "stored_files",
        "select path, snapshot, case when stored_files.path is null then null "
        "when content is null then 1 else strlen(content) end::bigint as size, true as fits, "
        "length(content) as n_chars from feed left join stored_files using (path)",
    ),
    "load_elements": over_feed("file_content", ELEMENTS + "select * from elements"),
    "missing_files": over_feed(
        "file_content",
        "select * from feed where not exists "
        "(select 1 from file_content where file_content.path = feed.path)",
    ),
    "present_files": over_feed(
        "file_content",
        "select * from feed where exists "
        "(select 1 from file_content where file_content.path = feed.path)",
    ),
    "outcomes": over_feed("stored_files", OUTCOMES),
    "run_summary": over_feed(
        "stored_files",
        f""", outcomes as ({OUTCOMES})
        select count(*) as files, count(*) filter (where ok) as success,
               count(*) filter (where not ok) as errors
        from outcomes""",
    ),
    "process_files": over_index(
        """path, s2 as snapshot,
           not (contains(path, '/src1/') or suffix(path, '7.txt')) as ok,
           case when contains(path, '/src1/') then 'OSError: unreadable source'
                when suffix(path, '7.txt') then 'failed' end as error""",
        f"{EVERYTHING} and s2 > -1 and {UP_TO_LATEST}",
    ),
    "chunk_words": chunks(300, 10, 5000),
    "chunk_words_capped": chunks(200, 20, 900),
    "extract_page_text": PAGE_TEXT,
    "element_stats": over_feed(
        "file_content",
        ELEMENTS
        + """select count(*) as total_elements,
                    coalesce(sum(length(page_content)), 0)::bigint as total_content_length,
                    coalesce(sum(length(page_content)) / nullif(count(*), 0), 0)::double
                        as avg_element_length
             from elements""",
    ),
    "elements_by_type": over_feed(
        "file_content",
        ELEMENTS + "select category, count(*) as elements from elements group by category",
    ),
    "elements_by_source": over_feed(
        "file_content",
        ELEMENTS
        + """select source, split_part(source, '/', -1) as file_name, count(*) as elements
             from elements group by source""",
    ),
    "stream_changes": over_index(FEED, f"{ENGLISH} and s2 >= 0"),
    "manifest_run": over_index(
        f"case when s2 <= 9 then 'first' else 'second' end as run, {FEED}", f"{ENGLISH} and s2 > -1 and {UP_TO_LATEST}"
    ),
    "phrase_index": sql_over(
        "path_variants",
        body="""
        select phrase, read, lin, path
        from path_variants,
             (values ('/ifs/data', true), ('/ifs/data/ifs/da', false)) as p (phrase, first_only),
             (values ('before'), ('after')) as r (read)
        where contains(path, phrase) and (not first_only or lin % 3 = 0)""",
    ),
    "stream_snapshots": over_index(FEED, f"{ENGLISH} and (s2 > 6 or lin % 7 <> 0)"),
    "chunk_pieces": chunks(300, 10, 5000, of_feed=True),
    "element_pieces": over_feed("file_content", ELEMENTS + "select * from elements"),
    "document_pieces": over_feed("file_content", DOCUMENTS),
    "retry_failed": over_feed(
        "stored_files",
        f"""
        , said as ({OUTCOMES.replace("select path,", f"select path, {DELETED_ONLY} as gone,")}),
        owed as (select path, snapshot from said where snapshot <= 6 and not ok and not (gone and error = 'missing')),
        tried as (
            select path, snapshot, ok or (error = 'unreadable' and starts_with(path, '/ifs/data/en/')) as ok, error, gone,
                   (path, snapshot) in (select (path, snapshot) from owed) as again
            from said where snapshot > 6 or (path, snapshot) in (select (path, snapshot) from owed))
        select t.path, t.snapshot, t.ok, case when not t.ok then t.error end as error,
               case when not t.ok and not (t.gone and t.error = 'missing') then feed.change_types end as change_types,
               case when not t.ok and not (t.gone and t.error = 'missing') then case when t.again then 2 else 1 end end as attempts
        from tried t join feed on t.path = feed.path and t.snapshot = feed.snapshot""",
    ),
    "compact_log": sql_over(
        "document_commits",
        body="""
        select app, kind, scope, version, max(snapshot) + case when version = 1 then 1 else 0 end as snapshot
        from document_commits group by app, kind, scope, version""",
    ),
    "steady_predicates": sql_over(
        "file_index",
        body=" union all ".join(
            f"select '{name}' as dataset, {FEED} from file_index where {REGULAR} and ({text}) and s2 > -1 and s2 <= 12"
            for name, text in STEADY.items()
        ),
    ),
}
