"""Ad-hoc SQL over the published tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revscope.functions.display import display_value
from revscope.schemas import FEATURE_TABLES
from revscope.sources.readers import read_feature_csv

TABLE_VIEWS = {
    "sentiment_trends": "agg_sentiment_trends",
    "competitive_analysis": "agg_competitive_analysis",
    "success_prediction": "agg_success_prediction",
    "review_velocity": "agg_review_velocity",
}


def register_views(spark: SparkSession, tables: dict[str, DataFrame]) -> list[str]:
    """Expose DataFrames to SQL under their given names."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return list(tables)


def is_query(spark: SparkSession, sql: str) -> bool:
    """Whether ``sql`` parses to a query: no command and no insertion anywhere in its plan."""
    plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(sql)
    kinds = [
        spark._jvm.java.lang.Class.forName(f"org.apache.spark.sql.catalyst.plans.logical.{name}")
        for name in ("Command", "ParsedStatement")
    ]
    waiting = [plan]
    while waiting:
        node = waiting.pop()
        if any(kind.isInstance(node) for kind in kinds):
            return False
        children = node.children()
        waiting += [children.apply(i) for i in range(children.size())]
    return True


@dataclass(frozen=True)
class QueryLimits:
    """What a query may cost by the optimised plan's own estimates, before anything runs."""

    scan_bytes: int = 1 << 40   # columns read from one table without a filter or limit of the user's
    loop_rows: int = 10_000     # proven rows of the smaller side of a join that has no equality


def _kind(node) -> str:
    return node.getClass().getSimpleName()


def _listed(seq) -> list:
    return [seq.apply(i) for i in range(seq.size())]


def _narrows(condition) -> bool:
    """Whether a filter is more than the null checks that a join or aggregate implies."""
    if _kind(condition) == "And":
        return any(_narrows(c) for c in _listed(condition.children()))
    return _kind(condition) != "IsNotNull"


def _whole_scans(node, read=None) -> list[tuple[str, int]]:
    """(table, bytes) of leaves read whole: no filter or limit between them and what gathers their rows."""
    below = [x for q in _listed(node.subqueries()) for x in _whole_scans(q)]
    kind, children = _kind(node), _listed(node.children())
    if kind in ("LocalLimit", "GlobalLimit") or kind == "Filter" and _narrows(node.condition()):
        if _streams(children[0]):
            return below
        read = None
    elif kind == "LogicalRDD":  # rows made in the session: no statistics to judge
        return below
    elif not children:
        return [*below, (node.simpleString(3), int((read or node).stats().sizeInBytes()))]
    else:
        # a projection or null check over a leaf says which columns are read
        read = (read or node) if kind in _STREAMING else None
    return below + [x for c in children for x in _whole_scans(c, read)]


_STREAMING = ("Project", "Filter", "LocalLimit", "GlobalLimit", "SubqueryAlias")


def _streams(node) -> bool:
    """Whether rows flow from one leaf through ``node`` without being gathered."""
    children = _listed(node.children())
    return not children or _kind(node) in _STREAMING and _streams(children[0])


def _loops(spark: SparkSession, node) -> list:
    """Joins that compare every row of one side with every row of the other."""
    keys = spark._jvm.org.apache.spark.sql.catalyst.planning
    here = _kind(node) == "Join" and not any(x.unapply(node).isDefined() for x in (keys.ExtractEquiJoinKeys, keys.ExtractSingleColumnNullAwareAntiJoin))
    below = _listed(node.children()) + _listed(node.subqueries())
    return ([node] if here else []) + [x for c in below for x in _loops(spark, c)]


def _most_rows(plan) -> float:
    rows = plan.maxRows()
    return int(rows.get()) if rows.isDefined() else float("inf")


def objections(df: DataFrame, limits: QueryLimits = QueryLimits()) -> list[str]:
    """Why a query should not run, in words; nothing if it may.  Reads the optimised plan and its
    statistics only: no job runs.

    Refused are a join without an equality whose smaller side is not proven to be small
    (``maxRows``: a limit, a global aggregate, literal rows), and a table of which more than
    ``scan_bytes`` would be read (the columns used, by their width) with no filter or limit on it.
    Frames made from rows of the session have no statistics and are not judged by size."""
    plan, wrong = df._jdf.queryExecution().optimizedPlan(), []
    for join in _loops(df.sparkSession, plan):
        if min(map(_most_rows, _listed(join.children()))) > limits.loop_rows:
            wrong.append("a join without an equality compares all rows of both sides")
    for table, size in _whole_scans(plan):
        if size > limits.scan_bytes:
            wrong.append(f"{table}: {size} bytes read without a filter, more than {limits.scan_bytes}")
    return wrong


def ask_sql(spark: SparkSession, tables: dict[str, DataFrame], sql: str, read_only: bool = True, limits: QueryLimits | None = QueryLimits()) -> DataFrame:
    """Run one query over the registered tables (Q1).  The text goes through
    Spark's parser and Catalyst like any SQL; joins, subqueries and CTEs work.
    ``spark.sql`` runs DDL/DML statements immediately, so by default a text
    whose parsed plan holds a command or an insertion is refused; so is a query
    that meets ``objections`` (``limits=None`` lets all run)."""
    if read_only and not is_query(spark, sql):
        raise ValueError("only query statements (SELECT/WITH/VALUES/TABLE) are accepted")
    register_views(spark, tables)
    answer = spark.sql(sql)
    if read_only and limits is not None and (wrong := objections(answer, limits)):
        raise ValueError("refused: " + "; ".join(wrong))
    return answer


def open_published(spark: SparkSession, base: str, csv: bool = False) -> dict[str, DataFrame]:
    """The published tables under ``base`` as their ``agg_*`` views, in one call:
    Parquet folders by default, headered CSV folders with ``csv``."""
    tables = {}
    for name, view in TABLE_VIEWS.items():
        path = f"{base.rstrip('/')}/{name}"
        tables[view] = read_feature_csv(spark, path, FEATURE_TABLES[name]) if csv else spark.read.parquet(path)
    register_views(spark, tables)
    return tables


def open_tables(spark: SparkSession, names: dict[str, str] | None = None) -> dict[str, DataFrame]:
    """The typed catalog tables (``writers.create_feature_tables``) as their
    ``agg_*`` views.  Their buckets come along: a join or an aggregate on the
    distribution key reads them bucket by bucket, without a shuffle, and a filter
    on it opens its own buckets only."""
    tables = {view: spark.table((names or {}).get(name, name)) for name, view in TABLE_VIEWS.items()}
    register_views(spark, tables)
    return tables


def format_result(df: DataFrame, n: int = 20) -> dict:
    """Text rendering of a result (Q2): a ' | ' header, the first ``n`` rows
    with NULL shown as 'NULL' and floats with two decimals, and the true row
    count (counted by Spark, not by fetching the rows)."""
    row_count = df.count()
    if row_count == 0:
        return {"success": True, "row_count": 0, "data": "No results found"}
    cells = [display_value(f.name, f.dataType) for f in df.schema.fields]
    lines = df.limit(n).select(F.concat_ws(" | ", *cells).alias("line")).collect()
    text = "Results:\n" + " | ".join(df.columns) + "\n" + "".join(r.line + "\n" for r in lines)
    return {"success": True, "row_count": row_count, "data": text}
