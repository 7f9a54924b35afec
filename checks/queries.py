"""One query per operator, each over whole tables."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import snapfeed as sf
from snapfeed.scratch import scratch_dir, stored
from snapfeed.sources.files import file_uri
from snapfeed.sources.packing import OPEN_BYTES

from .views import STEADY, definitions, table, view

EVERYTHING = sf.FolderScope("/ifs/data")
ENGLISH = sf.FolderScope("/ifs/data/en/")
CHUNK = ("path", "chunk_no", "piece_no", "chunk")


def joined(df: DataFrame) -> DataFrame:
    """Change lists as text, for comparison."""
    return df.withColumn("change_types", F.array_join("change_types", ","))


def flat_documents(documents: DataFrame) -> DataFrame:
    return joined(documents.select("page_content", "metadata.*"))


def index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sf.sources.index.with_change_list(view(spark, sf_dir, "file_index"))


def full_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = index(spark, sf_dir)
    return sf.directory_changes(entries, EVERYTHING, -1, sf.latest_snapshot(entries))


def english_run(spark: SparkSession, sf_dir: str, committed: int | None = None, **options):
    log = sf.CheckpointLog(spark, scratch_dir(spark, "checkpoints"))
    if committed is not None:
        log.commit("app_a", ENGLISH.kind, ENGLISH.key, 1, committed)
    return sf.IncrementalRun(index(spark, sf_dir), log, ENGLISH, app="app_a", **options)


def index_scan(spark, sf_dir):
    nested = sf.nest_index(view(spark, sf_dir, "file_index"))
    return joined(sf.flatten_index(nested))


def index_scan_json(spark, sf_dir):
    path = scratch_dir(spark, "index")
    sf.nest_index(view(spark, sf_dir, "file_index")).write.json(path)
    return joined(sf.read_index(spark, path, format="json"))


def index_layout(spark, sf_dir):
    path = scratch_dir(spark, "index")
    sf.write_index(index(spark, sf_dir), path)
    stored = sf.read_index(spark, path, nested=False)
    return joined(sf.directory_changes(stored, ENGLISH, 9, sf.latest_snapshot(stored)))


def regular_files(spark, sf_dir):
    return joined(sf.regular_files(index(spark, sf_dir)))


def folder_prefix(spark, sf_dir):
    return sf.under_folder(view(spark, sf_dir, "path_variants"), "/ifs/data/ ")


def folder_subtree(spark, sf_dir):
    return sf.under_folder(view(spark, sf_dir, "path_variants"), "/ifs/data", "subtree")


def folder_phrase(spark, sf_dir):
    return sf.under_folder(view(spark, sf_dir, "path_variants"), "/ifs/data", "phrase")


def scan_scope(spark, sf_dir):
    return joined(sf.scan_scope(index(spark, sf_dir), ENGLISH))


def dataset_scope(spark, sf_dir):
    entries = index(spark, sf_dir)
    scope = sf.DatasetScope.lookup(definitions(spark), "en_or_de")
    return joined(sf.directory_changes(entries, scope, -1, sf.latest_snapshot(entries)))


def in_dataset(spark, sf_dir):
    return joined(sf.in_dataset(index(spark, sf_dir), definitions(spark), "not_src1"))


def changed_between(spark, sf_dir):
    return joined(sf.changed_between(index(spark, sf_dir), 3, 8))


def latest_snapshot(spark, sf_dir):
    return sf.operators.feed.latest_snapshot_row(index(spark, sf_dir))


def last_snapshot(spark, sf_dir):
    log = view(spark, sf_dir, "commit_log")
    keys = [
        ("app_1", "folder_paths", "/ifs/data/error", 1),
        ("app_1", "folder_paths", "/ifs/data/error", 2),
        ("app_1", "datasets", "/ifs/data/error", 1),
    ]
    found = [
        sf.last_snapshot_row(log, *key).select(
            F.lit(number).alias("key_no"), F.lit(key[1]).alias("kind"), "snapshot"
        )
        for number, key in enumerate(keys)
    ]
    return found[0].union(found[1]).union(found[2])


def current_checkpoints(spark, sf_dir):
    return sf.current_checkpoints(view(spark, sf_dir, "commit_log"))


def checkpoint_commit(spark, sf_dir):
    """Runs and commits over every language; stale and repeated commits change nothing."""
    entries = index(spark, sf_dir)
    log = sf.CheckpointLog(spark, scratch_dir(spark, "checkpoints"))
    languages = [row.lang for row in table(spark, sf_dir, "documents").select("lang").distinct().collect()]
    for folder in (f"/ifs/data/{lang}" for lang in sorted(languages)):
        with sf.IncrementalRun(entries, log, sf.FolderScope(folder), app="app_a") as run:
            run.changes().write.format("noop").mode("overwrite").save()
        run.commit()
        log.commit("app_a", run.scope.kind, run.scope.key, 1, run.high - 5)
    log.commit("app_a", "folder_paths", "/ifs/data/en", 2, 2)
    return log.current()


def checkpoint_modes(spark, sf_dir):
    """One application in all modes of one folder; each mode has its own first run."""
    entries = sf.sources.index.with_change_list(view(spark, sf_dir, "mode_index"))
    log = sf.CheckpointLog(spark, scratch_dir(spark, "checkpoints"))
    found = []
    for mode in ("prefix", "subtree", "phrase"):
        run = sf.IncrementalRun(entries, log, sf.FolderScope("/ifs/data", mode), app="app_a")
        found.append(run.changes().select(F.lit(mode).alias("mode"), "*"))
        run.commit()
    return joined(found[0].union(found[1]).union(found[2]))


def changes_first_run(spark, sf_dir):
    return joined(english_run(spark, sf_dir).changes())


def changes_incremental(spark, sf_dir):
    return joined(english_run(spark, sf_dir, committed=9).changes())


def changes_forced(spark, sf_dir):
    return joined(english_run(spark, sf_dir, committed=9, force_scan=True).changes())


def changes_since(spark, sf_dir):
    return joined(english_run(spark, sf_dir, committed=9, since=4).changes())


def new_files(spark, sf_dir):
    return english_run(spark, sf_dir, committed=9).new_files()


def deleted_files(spark, sf_dir):
    return english_run(spark, sf_dir, committed=9).deleted_files()


def all_files(spark, sf_dir):
    return sf.all_files(index(spark, sf_dir), EVERYTHING)


def run_all_files(spark, sf_dir):
    return english_run(spark, sf_dir, committed=9).all_files()


def document_feed(spark, sf_dir):
    return flat_documents(english_run(spark, sf_dir).documents())


def page_after(spark, sf_dir):
    entries = sf.scan_scope(index(spark, sf_dir), EVERYTHING)
    return joined(sf.page_after(entries, (100, "/ifs/data"), 500))


def page_walk(spark, sf_dir):
    """Four pages in turn over an index in which numbers and paths are missing."""
    entries = sf.sources.index.with_change_list(view(spark, sf_dir, "gap_index"))
    size = -(-entries.count() // 4)
    pages, last = [], None
    for number in range(4):
        page = sf.page_after(entries, last, size)
        pages.append(page.select(F.lit(number).alias("page"), "*"))
        end = page.tail(1)
        if not end:
            break
        last = (end[0]["lin"], end[0]["path"])
    return joined(reduce(DataFrame.union, pages))


def number_pages(spark, sf_dir):
    return joined(sf.number_pages(sf.scan_scope(index(spark, sf_dir), EVERYTHING), 100))


def load_documents(spark, sf_dir):
    content = view(spark, sf_dir, "file_content")
    return flat_documents(sf.load_documents(full_feed(spark, sf_dir), content))


def load_wide_feed(spark, sf_dir):
    """A feed with a nested column, which is carried along and weighed."""
    feed = full_feed(spark, sf_dir)
    wide = feed.withColumn("extra", F.struct(F.upper("path").alias("name"), F.array("snapshot").alias("list")))
    content = view(spark, sf_dir, "file_content")
    return sf.balanced_join(wide, content, "path", "inner").select(
        "path", "snapshot", F.col("extra.name").alias("name"), F.col("extra.list")[0].alias("first"), "content"
    )


def load_elements(spark, sf_dir):
    content = view(spark, sf_dir, "file_content")
    return flat_documents(sf.load_elements(full_feed(spark, sf_dir), content))


def open_files(spark, sf_dir):
    """The texts as files on storage, one each, read back by the feed."""
    root = scratch_dir(spark, "files")
    write_files(view(spark, sf_dir, "file_content"), root)
    opened = sf.open_changed_files(full_feed(spark, sf_dir), root, partitions=8)
    return flat_documents(sf.document_rows(opened))


def loaded_outcomes(spark, sf_dir):
    """One load of the files on storage: its outcomes, and the documents it gave."""
    root = scratch_dir(spark, "files")
    write_files(view(spark, sf_dir, "stored_files"), root)
    log = sf.CheckpointLog(spark, scratch_dir(spark, "checkpoints"))
    loader = sf.ContentLoader(index(spark, sf_dir), log, "/ifs/data", root=root, partitions=8)
    documents = loader.load().select(
        F.col("metadata.source").alias("path"),
        F.col("metadata.snapshot").alias("snapshot"),
        F.length("page_content").cast("long").alias("n_chars"),
    )
    return loader.outcomes().join(documents, ["path", "snapshot"], "left")


def bucketed_content(spark, sf_dir):
    """Documents of a full run over content in buckets, of which nothing is shuffled."""
    table = sf.ContentTable(spark, scratch_dir(spark, "content"))
    content = view(spark, sf_dir, "file_content")
    table.write(content.where("path like '/ifs/data/en/%'"), buckets=16)
    table.write(content.where("path not like '/ifs/data/en/%'"))
    return flat_documents(sf.document_rows(table.join(full_feed(spark, sf_dir), broadcast_bytes=0)))


def packed_files(spark, sf_dir):
    """Files on storage dealt out by bytes, each with its size, what was read of it, and whether its task is small enough."""
    root = scratch_dir(spark, "files")
    write_files(view(spark, sf_dir, "stored_files"), root)
    feed = full_feed(spark, sf_dir)
    limit = 16 << 20
    packed, _ = sf.packed_files(feed, root, limit)
    load = F.sum(F.coalesce("size", F.lit(0)) + OPEN_BYTES)
    tasks = packed.groupBy("task").agg(((load <= limit) | (F.count("*") == 1)).alias("fits"))
    opened = sf.open_changed_files(feed, root, task_bytes=limit)
    read = opened.select("path", "snapshot", F.length("content").cast("long").alias("n_chars"))
    sizes = packed.join(tasks, "task").select("path", "snapshot", "size", "fits")
    return sizes.join(read, ["path", "snapshot"])


def write_files(content: DataFrame, root: str) -> None:
    """A file per row; without content, one that is not text. A worker holds one text beside its batch."""
    uri = file_uri(root)

    def write(batches):
        import pyarrow as pa
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)
        for batch in batches:
            for path, text in zip(batch["path"], batch["content"], strict=True):
                path, text = path.as_py(), text.as_py()
                store.create_dir(base + path.rpartition("/")[0], recursive=True)
                with store.open_output_stream(base + path, compression=None) as file:
                    file.write(b"\xff" if text is None else text.encode())
            yield pa.RecordBatch.from_pydict({"files": [batch.num_rows]})

    spread = content.repartition(8)
    spread.mapInArrow(write, "files bigint").agg(F.sum("files")).first()


def missing_files(spark, sf_dir):
    content = view(spark, sf_dir, "file_content")
    return joined(sf.missing_files(full_feed(spark, sf_dir), content))


def present_files(spark, sf_dir):
    content = view(spark, sf_dir, "file_content")
    return joined(sf.present_files(full_feed(spark, sf_dir), content))


def outcomes(spark, sf_dir):
    return sf.outcomes(full_feed(spark, sf_dir), view(spark, sf_dir, "stored_files"))


def run_summary(spark, sf_dir):
    return sf.run_summary(outcomes(spark, sf_dir))


def process_files(spark, sf_dir):
    def process(path):
        if "/src1/" in path:
            raise OSError("unreadable source")
        return not path.endswith("7.txt")

    return sf.process_files(full_feed(spark, sf_dir), process)


def chunk_words(spark, sf_dir):
    content = view(spark, sf_dir, "file_content")
    return sf.chunk_words(content, text="content").select(*CHUNK)


def chunk_words_capped(spark, sf_dir):
    content = view(spark, sf_dir, "file_content")
    return sf.chunk_words(content, 200, 20, 900, text="content").select(*CHUNK)


def extract_page_text(spark, sf_dir):
    return sf.extract_page_text(table(spark, sf_dir, "pages"))


def _elements(spark, sf_dir):
    return sf.load_elements(full_feed(spark, sf_dir), view(spark, sf_dir, "file_content"))


def element_stats(spark, sf_dir):
    return sf.element_stats(_elements(spark, sf_dir))


def elements_by_type(spark, sf_dir):
    return sf.elements_by_type(_elements(spark, sf_dir))


def elements_by_source(spark, sf_dir):
    return sf.elements_by_source(_elements(spark, sf_dir))


def stream_changes(spark, sf_dir):
    """The index arrives in two drops; each start of the stream takes what is new."""
    entries = index(spark, sf_dir)
    drops, sink, state = (scratch_dir(spark, name) for name in ("drops", "sink", "stream"))
    for drop in (entries.where("s2 <= 6"), entries.where("s2 > 6")):
        sf.nest_index(drop).write.mode("append").parquet(drops)
        feed = sf.stream_changes(sf.read_index_stream(spark, drops), ENGLISH)
        sf.write_available(feed, state, sink=sink)
    return joined(spark.read.parquet(sink))


def manifest_run(spark, sf_dir):
    """Two writes and a run after each; bounds and files come from the record of the writes."""
    entries = index(spark, sf_dir)
    table = sf.IndexTable(spark, scratch_dir(spark, "index"))
    log = sf.CheckpointLog(spark, scratch_dir(spark, "checkpoints"))
    found = []
    for name, new in (("first", "s2 <= 9"), ("second", "s2 > 9")):
        table.append(entries.where(new))
        with sf.IncrementalRun(table, log, ENGLISH, app="app_a") as run:
            found.append(run.changes().select(F.lit(name).alias("run"), "*"))
    return joined(found[0].union(found[1]))


def phrase_index(spark, sf_dir):
    """Phrases over a table of two writes, one indexed for phrases and one not; then both."""
    entries = view(spark, sf_dir, "path_variants").selectExpr(
        "*", "'regular' as file_type", "lin % 13 as s2", "cast(null as array<string>) as change_types"
    )
    table = sf.IndexTable(spark, scratch_dir(spark, "index"))
    found = []
    for part, phrase in (("lin % 3 = 0", "/ifs/data"), ("lin % 3 <> 0", "/ifs/data/ifs/da")):
        table.append(entries.where(part))
        kept = sf.under_folder(table.read(phrase=phrase), phrase, "phrase")
        table.index_phrases()
        again = sf.under_folder(table.read(phrase=phrase), phrase, "phrase")
        for name, rows in (("before", kept), ("after", again)):
            found.append(rows.select(F.lit(phrase).alias("phrase"), F.lit(name).alias("read"), "lin", "path"))
    return reduce(DataFrame.union, found)


def stream_snapshots(spark, sf_dir):
    """A stream by snapshots over two writes; what comes late with an old snapshot is passed over."""
    entries = index(spark, sf_dir)
    table = sf.IndexTable(spark, scratch_dir(spark, "index"))
    sink, state = (scratch_dir(spark, name) for name in ("sink", "stream"))
    for new in ("s2 <= 6 and lin % 7 <> 0", "s2 > 6 or lin % 7 = 0"):
        table.append(entries.where(new))
        feed = sf.stream_changes(sf.read_snapshot_stream(spark, table.path), ENGLISH)
        sf.write_available(feed, state, sink=sink)
    return joined(spark.read.parquet(sink))


def _in_pieces(spark, sf_dir):
    """The feed with its texts in pieces of 4,096 characters, wherever that cuts them."""
    content = view(spark, sf_dir, "file_content")
    files = sf.balanced_join(full_feed(spark, sf_dir), content, "path", "inner")
    pieces = F.regexp_extract_all("content", F.lit("(?s).{1,4096}"), F.lit(0))
    cut = files.withColumn("pieces", F.when(F.col("content") == "", F.array(F.lit(""))).otherwise(pieces)).drop("content")
    cut = cut.withColumn("lines", F.transform("pieces", lambda piece: F.regexp_count(piece, F.lit("\n")).cast("long")))
    cut = cut.select("*", F.posexplode("pieces").alias("piece_no", "content"), F.size("pieces").alias("n")).drop("pieces")
    before = F.aggregate(F.slice("lines", F.lit(1), F.col("piece_no")), F.lit(0).cast("long"), lambda total, n: total + n)
    return cut.select(
        "path", "snapshot", "change_types", "piece_no", before.alias("first_line"),
        (F.col("piece_no") < F.col("n") - 1).alias("more"), "content", F.lit(None).cast("string").alias("error"),
    )


def chunk_pieces(spark, sf_dir):
    return sf.chunk_pieces(_in_pieces(spark, sf_dir)).select(*CHUNK)


def element_pieces(spark, sf_dir):
    return flat_documents(sf.element_pieces(_in_pieces(spark, sf_dir)))


def document_pieces(spark, sf_dir):
    return flat_documents(sf.whole_documents(_in_pieces(spark, sf_dir)))


def retry_failed(spark, sf_dir):
    """Two runs; some files were mended in between, and failed ones come again."""
    entries = index(spark, sf_dir)
    table = sf.IndexTable(spark, scratch_dir(spark, "index"))
    log = sf.CheckpointLog(spark, scratch_dir(spark, "checkpoints"))
    failures = sf.FailureLedger(spark, scratch_dir(spark, "failures"))
    before, after = (view(spark, sf_dir, name) for name in ("stored_files", "mended_files"))
    for new, content in (("s2 <= 6", before), ("s2 > 6", after)):
        table.append(entries.where(new))
        loader = sf.ContentLoader(table, log, "/ifs/data", content=content, failures=failures)
        loader.load().write.format("noop").mode("overwrite").save()
        loader.commit()
    tried = stored(loader.outcomes(), "outcomes")
    left = failures.open(*loader.current_run.key)
    return joined(tried.join(left.drop("error"), ["path", "snapshot"], "left"))


def compact_log(spark, sf_dir):
    """A long log in the older form, brought down in place while commits go on."""
    commits = view(spark, sf_dir, "document_commits")
    path = scratch_dir(spark, "checkpoints")
    commits.write.parquet(f"{path}/commit=0")
    log = sf.CheckpointLog(spark, path)
    ahead = log.current().where("version = 1").collect()
    with ThreadPoolExecutor(4) as pool:
        done = pool.submit(log.compact)
        list(pool.map(lambda row: log.commit(*row[:4], row.snapshot + 1), ahead))
        done.result()
    log.compact()
    return log.read()


def steady_predicates(spark, sf_dir):
    """Every dataset of a table of conditions, as a scope."""
    entries = index(spark, sf_dir)
    names = sorted(STEADY)
    texts = spark.createDataFrame(list(STEADY.items()), "dataset string, predicate string")
    found = [
        sf.directory_changes(entries, sf.DatasetScope.lookup(texts, name), -1, 12).select(F.lit(name).alias("dataset"), "*")
        for name in names
    ]
    return joined(reduce(DataFrame.union, found))


QUERIES = {
    query.__name__: query
    for query in (
        index_scan,
        index_scan_json,
        index_layout,
        regular_files,
        folder_prefix,
        folder_subtree,
        folder_phrase,
        scan_scope,
        dataset_scope,
        in_dataset,
        changed_between,
        latest_snapshot,
        last_snapshot,
        current_checkpoints,
        checkpoint_commit,
        checkpoint_modes,
        changes_first_run,
        changes_incremental,
        changes_forced,
        changes_since,
        new_files,
        deleted_files,
        all_files,
        run_all_files,
        document_feed,
        page_after,
        page_walk,
        number_pages,
        load_documents,
        load_wide_feed,
        load_elements,
        open_files,
        loaded_outcomes,
        packed_files,
        bucketed_content,
        missing_files,
        present_files,
        outcomes,
        run_summary,
        process_files,
        chunk_words,
        chunk_words_capped,
        extract_page_text,
        element_stats,
        elements_by_type,
        elements_by_source,
        stream_changes,
        manifest_run,
        phrase_index,
        stream_snapshots,
        chunk_pieces,
        element_pieces,
        document_pieces,
        retry_failed,
        compact_log,
        steady_predicates,
    )
}
