"""Files dealt out to tasks by their bytes."""

from pathlib import Path

import pandas as pd
from hypothesis import given
from hypothesis import strategies as st
from pyspark import TaskContext
from pyspark.sql import functions as F

import snapfeed as sf
from snapfeed.sources import packing
from snapfeed.sources.packing import OPEN_BYTES, pack, pack_feed, windows

FEED = "path string, snapshot bigint, change_types array<string>"


@given(st.lists(st.integers(1, 100), max_size=60), st.integers(20, 120))
def test_no_bin_is_overfull(weights, limit):
    bins = pack(weights, limit)
    assert sorted(set(bins)) == list(range(len(set(bins))))
    loads = [[w for w, b in zip(weights, bins, strict=True) if b == k] for k in set(bins)]
    assert all(sum(load) <= limit or len(load) == 1 for load in loads)
    # two bins that would fit into one are never both left open
    sums = sorted(map(sum, loads))
    assert len(sums) < 2 or sums[0] + sums[1] > limit


@given(st.lists(st.integers(0, 9), max_size=8), st.integers(1, 7))
def test_windows_keep_all_rows(sizes, rows):
    numbers = iter(range(100))
    batches = [pd.DataFrame({"n": [next(numbers) for _ in range(size)]}) for size in sizes]
    got = list(windows(iter(batches), rows))
    assert [n for frame in got for n in frame["n"]] == list(range(sum(sizes)))
    assert all(len(frame) == rows for frame in got[:-1]) and all(len(frame) for frame in got)


def test_every_task_is_small_or_a_single_file(spark):
    """Sizes from a few bytes to beyond the limit; one path is a third of the feed."""
    rows = [(f"/f{n % 2000 if n % 3 else 0}", n, []) for n in range(6000)]
    feed = spark.createDataFrame(rows, FEED)

    def size_of():
        return lambda path: None if path == "/f7" else int(path[2:]) ** 2

    limit = 1 << 21
    packed, tasks = pack_feed(feed, size_of, limit)
    got = packed.toPandas()
    assert sorted(got.snapshot) == list(range(6000)) and got.change_types.map(len).sum() == 0
    assert got[got.path == "/f7"]["size"].isna().all() and (got[got.path == "/f30"]["size"] == 900).all()
    got["weight"] = got["size"].fillna(0) + OPEN_BYTES
    loads = got.groupby("task").weight.agg(["sum", "count"])
    assert sorted(loads.index) == list(range(tasks))
    assert ((loads["sum"] <= limit) | (loads["count"] == 1)).all()
    assert tasks <= 1.25 * got.weight.sum() / limit + spark.sparkContext.defaultParallelism
    ids = packed.repartitionById(tasks, "task").select("task", F.spark_partition_id().alias("at"))
    assert ids.where("task <> at").count() == 0 and ids.rdd.getNumPartitions() == tasks


def test_packs_of_a_task_are_numbered_on(spark, monkeypatch):
    feed = spark.range(0, 50, 1, 1).selectExpr("concat('/', id) as path", "'mine' as size", "id as task")

    def size_of():
        packing.PACK_FILES = 7  # in the worker
        return lambda path: 10

    packed, tasks = pack_feed(feed, size_of, OPEN_BYTES + 10)
    assert tasks == 50 and sorted(r.task for r in packed.collect()) == list(range(50))
    assert packed.columns == ["path", "size", "task"]


def test_files_are_opened_as_packed(spark, tmp_path):
    for n in range(40):
        Path(tmp_path, f"f{n}").write_text("x" * (n * 50_000 if n % 10 == 0 else n) + "\n")
    rows = [(f"/f{n}", n, ["ENTRY_ADDED"]) for n in range(42)] + [(None, 99, None), ("/f3", 98, [])]
    feed = spark.createDataFrame(rows, FEED)
    limit = 1 << 19
    opened = sf.open_changed_files(feed, str(tmp_path), task_bytes=limit, piece_bytes=1 << 18)
    got = opened.withColumn("at", F.spark_partition_id()).toPandas()
    whole = got.sort_values("piece_no").groupby("snapshot").content.agg(lambda c: sum(len(x or "") for x in c))
    assert whole.to_dict() == {
        **{n: (n * 50_000 if n % 10 == 0 else n) + 1 for n in range(40)}, 40: 0, 41: 0, 98: 4, 99: 0
    }
    assert got.set_index("snapshot").error.dropna().to_dict() == {40: "missing", 41: "missing", 99: "unreadable"}
    assert got.groupby("snapshot")["at"].nunique().max() == 1
    read = got.groupby("at").agg(bytes=("content", lambda c: sum(len(x or "") for x in c)), files=("snapshot", "nunique"))
    assert ((read.bytes + read.files * OPEN_BYTES <= limit) | (read.files == 1)).all()
    sizes = {r.path: r["size"] for r in sf.packed_files(feed, str(tmp_path))[0].collect()}
    assert sizes["/f20"] == 1_000_001 and sizes["/f41"] is None and sizes[None] is None
    empty, tasks = sf.packed_files(feed.limit(0), str(tmp_path))
    assert tasks == 0 and empty.count() == 0
    assert sf.open_changed_files(feed.limit(0), str(tmp_path)).count() == 0
    assert TaskContext.get() is None
