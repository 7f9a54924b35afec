"""Named datasets: a table of ``(dataset, predicate)``."""

from __future__ import annotations

from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import INDEX_SCHEMA


def dataset_predicate(definitions: DataFrame, name: str) -> str:
    """Predicate text of a dataset; ``ValueError`` if there is none.

    A name is a key of the definition table. Two different definitions under
    one name are an error as well, since either could be meant.
    """
    rows = (
        definitions.where(F.col("dataset") == name)
        .select("predicate")
        .distinct()
        .limit(2)
        .collect()
    )
    if not rows:
        raise ValueError(f"dataset not found: {name}")
    if len(rows) > 1:
        raise ValueError(f"dataset has more than one definition: {name}")
    return check_predicate(rows[0].predicate)


def check_predicate(predicate: str | None) -> str:
    """Let through conditions on the columns of an entry that stay true or false.

    Spark analyses the predicate, and what it says of the result counts: a condition
    with a subquery, a call into the JVM, a function that gives another value each
    time, or one that follows the clock, the session or the file that a row is read
    from, is refused, since a run would pass over what it leaves out. So is what is
    no condition at all. Columns that an index may have beside the usual ones are
    taken to be of any type.
    """
    if not predicate or not predicate.strip():
        raise ValueError("empty dataset predicate")
    condition = _analysed(predicate)
    patterns = _spark().sparkContext._jvm.org.apache.spark.sql.catalyst.trees.TreePattern
    if condition.containsPattern(patterns.PLAN_EXPRESSION()):
        raise ValueError(f"dataset predicate must be a plain column condition: {predicate}")
    if not condition.deterministic() or condition.containsPattern(patterns.CURRENT_LIKE()):
        raise ValueError(f"dataset predicate must not change from row to row or with time: {predicate}")
    return predicate


def _spark() -> SparkSession:
    return SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()


def _analysed(predicate: str):
    """The condition as Spark resolves it over an index."""
    columns = [F.lit(None).cast(field.dataType).alias(field.name) for field in INDEX_SCHEMA]
    unknown: set[str] = set()
    while True:
        entries = _spark().range(0).select(*columns, *(F.lit(None).alias(name) for name in sorted(unknown)))
        try:
            # through the plan of a filter, which refuses aggregates, windows and what is not boolean
            return entries.where(F.expr(predicate))._jdf.queryExecution().analyzed().condition()
        except ParseException as error:
            raise ValueError(f"dataset predicate cannot be parsed: {predicate}") from error
        except AnalysisException as error:
            name = (error.getMessageParameters() or {}).get("objectName", "").strip("`")
            if not (error.getCondition() or "").startswith("UNRESOLVED_COLUMN") or not name.isidentifier() or name in unknown:
                raise ValueError(f"dataset predicate must be a plain column condition: {predicate}: {error.getCondition()}") from error
            if name.startswith("_"):
                raise ValueError(f"dataset predicate must not depend on the file of a row: {predicate}") from error
            unknown.add(name)
