"""Inputs of the checks, derived row by row from the given tables.

The same SQL text runs in Spark, over DataFrames, and in DuckDB, over its views.
Every row of a table becomes a row of its view; no text is shortened.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

VIEWS = {
    # Regular and other files, all spellings of the change list, snapshots 0 to 12.
    "file_index": """
        select doc_id as lin,
               '/ifs/data/' || lang || '/' || source || '/doc' || cast(doc_id as string) || '.txt'
                   as path,
               case when doc_id % 20 = 0 then 'directory'
                    when doc_id % 20 = 10 then 'symlink'
                    else 'regular' end as file_type,
               (doc_id * 7) % 13 as s2,
               case doc_id % 6
                    when 0 then split('ENTRY_ADDED', ',')
                    when 1 then split('ENTRY_ADDED,FIXTURE_OTHER', ',')
                    when 2 then split('ENTRY_DELETED', ',')
                    when 3 then split('FIXTURE_OTHER', ',')
                    when 4 then split('ENTRY_ADDED,ENTRY_DELETED', ',')
                    else null end as change_types
        from {documents}""",
    # Paths on both sides of each border between the folder modes.
    "path_variants": """
        select doc_id as lin,
               case doc_id % 8
                    when 0 then '/ifs/data'
                    when 1 then '/ifs/data/' || source || '.txt'
                    when 2 then '/ifs/data2/' || source || '.txt'
                    when 3 then '/ifs/backup/ifs/data/' || source || '.txt'
                    when 4 then '/ifs/data/ifs/data/' || source || '.txt'
                    when 5 then '/ifs/dat/' || source || '.txt'
                    when 6 then '/IFS/DATA/' || source || '.txt'
                    else '/ifs/data.old/' || source end as path
        from {documents}""",
    # The index with gaps: entries without a file number and entries without a path.
    "gap_index": """
        select case when doc_id % 4 = 0 then null else doc_id end as lin,
               case when doc_id % 4 = 1 then null
                    else '/ifs/data/' || source || '/doc' || cast(doc_id as string) end as path,
               'regular' as file_type,
               doc_id % 13 as s2,
               case when doc_id % 2 = 0 then split('ENTRY_ADDED', ',') else null end
                   as change_types
        from {documents}""",
    # An index whose paths lie on both sides of the borders between the folder modes.
    "mode_index": """
        select doc_id as lin,
               case doc_id % 4
                    when 0 then '/ifs/data/' || source || '.txt'
                    when 1 then '/ifs/data2/' || source || '.txt'
                    when 2 then '/ifs/backup/ifs/data/' || source || '.txt'
                    else '/ifs/dat/' || source || '.txt' end as path,
               'regular' as file_type,
               doc_id % 13 as s2,
               case when doc_id % 2 = 0 then split('ENTRY_ADDED', ',') else null end
                   as change_types
        from {documents}""",
    # The files on storage. Some have moved, so their old paths have no content.
    "file_content": """
        select case when doc_id % 17 = 0 then '/ifs/archive/' else '/ifs/data/' end
                   || lang || '/' || source || '/doc' || cast(doc_id as string) || '.txt' as path,
               text as content
        from {documents}""",
    # As above; files with a mail address in them cannot be read as text.
    "stored_files": """
        select case when doc_id % 17 = 0 then '/ifs/archive/' else '/ifs/data/' end
                   || lang || '/' || source || '/doc' || cast(doc_id as string) || '.txt' as path,
               case when text like '%@%' then null else text end as content
        from {documents}""",
    # The same after the English ones have been mended.
    "mended_files": """
        select case when doc_id % 17 = 0 then '/ifs/archive/' else '/ifs/data/' end
                   || lang || '/' || source || '/doc' || cast(doc_id as string) || '.txt' as path,
               case when text like '%@%' and (lang <> 'en' or doc_id % 17 = 0) then null else text end as content
        from {documents}""",
    # Commits of a few applications, one per document.
    "document_commits": """
        select 'app_' || cast(doc_id % 5 as string) as app, 'folder_paths' as kind,
               '/ifs/data/' || lang as scope, cast(1 + doc_id % 3 as int) as version,
               (doc_id * 7) % 1009 as snapshot
        from {documents}""",
    # Commits of several applications, versions and scopes, in no order.
    "commit_log": """
        select 'app_' || cast(user_id % 5 as string) as app,
               case when event_type in ('click', 'view') then 'datasets'
                    else 'folder_paths' end as kind,
               '/ifs/data/' || event_type as scope,
               cast(1 + user_id % 3 as int) as version,
               cast(floor(value * 10) as bigint) as snapshot
        from {events}""",
}

# Definition texts that mean the same to both engines.
DATASETS = {
    "en_or_de": "(path like '/ifs/data/en/%' or path like '/ifs/data/de/%')",
    "not_src1": "not (path like '%/src1/%')",
}

# Further ones, each a dataset of its own.
STEADY = {
    "even": "s2 % 2 = 0 and lin is not null",
    "late_or_long": "s2 > 9 or length(path) > 28",
    "one_of": "(path like '%/src1/%') = (lin between 100 and 700)",
    "selected": "path not like '%(select 1)%' and upper(path) like '%DOC1%'",
}

TABLES = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
    "pages": "page_id bigint, url string, html string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    source = "events" if name == "commit_log" else "documents"
    return spark.sql(VIEWS[name], **{source: table(spark, sf_dir, source)})


def definitions(spark: SparkSession) -> DataFrame:
    rows = ", ".join(
        "('{}', '{}')".format(name, text.replace("'", "''")) for name, text in DATASETS.items()
    )
    return spark.sql(f"select * from values {rows} as t (dataset, predicate)")


def sql_over(*names: str, body: str) -> str:
    """Oracle text: the named views as common table expressions, then the body."""
    tables = {table: table for table in TABLES}
    ctes = ",\n".join(f"{name} as ({VIEWS[name].format(**tables)})" for name in names)
    return f"with {ctes}\n{body}"
