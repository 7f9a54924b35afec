"""Which files of an index can hold a phrase: its paths as pairs of neighbouring components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A component, the one before it, its place in the path and the file that holds such a path.
# The last component of a path is nearly always a name of its own, so that those below one
# folder are a range; a folder is a range from itself to itself.
PAIRS = "place int, parent string, low string, high string, is_folder boolean, file string"


def path_pairs(paths: DataFrame) -> DataFrame:
    """The pairs in the paths of each file, once each; ``paths`` has ``path`` and ``file``.

    Rows go with the folders of a file, not with its entries: the names below each
    folder are brought to one range before its path is taken apart. Paths that are
    null or have no slash have no pairs.
    """
    name = F.substring_index("path", "/", -1)
    above = F.substring("path", F.lit(1), F.length("path") - F.length(name) - 1)
    named = paths.where(F.col("path").contains("/")).select("file", F.split(above, "/", -1).alias("parts"), name.alias("name"))
    folders = named.groupBy("file", "parts").agg(F.min("name").alias("low"), F.max("name").alias("high"))

    def pair(place: Column, low: Column, high: Column, is_folder: bool) -> Column:
        parent = F.get("parts", place - 1)
        fields = (place.alias("place"), parent.alias("parent"), low.alias("low"), high.alias("high"))
        return F.struct(*fields, F.lit(is_folder).alias("is_folder"))

    size = F.size("parts")
    names = pair(size, F.col("low"), F.col("high"), False)
    within = F.transform(F.sequence(F.lit(1), size - 1), lambda i: pair(i, F.get("parts", i), F.get("parts", i), True))
    pairs = F.when(size > 1, F.concat(within, F.array(names))).otherwise(F.array(names))
    found = folders.select("file", F.inline(pairs))
    own = F.when(F.col("is_folder"), F.col("low"))
    grouped = found.groupBy("file", "place", "parent", "is_folder", own.alias("folder"))
    return grouped.agg(F.min("low").alias("low"), F.max("high").alias("high")).select(
        "place", "parent", "low", "high", "is_folder", "file"
    )


def can_prune(folder: str) -> bool:
    """Whether a phrase begins at the border of a component, as all below a root ``/...`` do."""
    return folder.startswith("/")


def files_with(pairs: DataFrame, folder: str) -> DataFrame:
    """Files in which the components of a phrase follow each other; at least those that hold it.

    Each pair of the phrase is looked up on its own, with literals that reach the
    scan, and the pairs meet where file and place of the beginning agree. A file may
    have the pairs from several paths, so what is read from it is still to be filtered.
    """
    parts = folder.split("/")[1:]
    hits = None
    for at in range(1 if len(parts) > 1 else 0, len(parts)):
        is_pair = _begins(parts[at]) if at == len(parts) - 1 else F.col("is_folder") & (F.col("low") == parts[at])
        if at:
            is_pair &= F.col("parent") == parts[at - 1]
        rows = pairs.where(is_pair).select("file", (F.col("place") - at).alias("start"))
        if at == 1:  # its parent is a component that a slash precedes
            rows = rows.where("start > 0")
        hits = rows if hits is None else hits.join(rows, ["file", "start"], "left_semi")
    return hits.select("file").distinct()


def _begins(part: str) -> Column:
    """Ranges that can hold a component that begins with ``part``."""
    low = F.col("low")
    return (F.col("high") >= part) & ((low <= part) | low.startswith(part)) & (
        ~F.col("is_folder") | low.startswith(part)
    )
