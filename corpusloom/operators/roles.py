"""Task detection and role mapping from column names."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom import fixed_values as fv
from corpusloom.functions.text import answer_text, strip

CHAT_TYPE = "array<struct<"


def alias_table(spark: SparkSession) -> DataFrame:
    """The task catalog as rows: one per (task, role, alias), a fixed small table."""
    rows = [
        (task, fv.TASK_ORDER.index(task), role, required, alias, rank)
        for task, role, required, aliases in fv.TASK_CATALOG
        for rank, alias in enumerate(aliases)
    ]
    return spark.createDataFrame(
        rows,
        "task string, task_rank int, role string, required boolean, alias string, alias_rank int",
    )


def column_catalog(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Column names and types of many tables, read from their schemas only."""
    rows = [
        (table, field.name, field.dataType.simpleString(), position)
        for table, df in tables.items()
        for position, field in enumerate(df.schema.fields)
    ]
    return spark.createDataFrame(
        rows, "table_name string, column_name string, column_type string, position int"
    )


def _hits(columns: DataFrame) -> DataFrame:
    """Columns that match an alias; of equal lower-case names the last one counts."""
    named = columns.groupBy("table_name", F.lower("column_name").alias("alias")).agg(
        F.max_by(F.struct("column_name", "column_type"), "position").alias("found")
    )
    aliases = alias_table(columns.sparkSession)
    return named.join(F.broadcast(aliases), "alias").select(
        "table_name", "task", "task_rank", "role", "required", "alias", "alias_rank", "found.*"
    )


def detect_tasks(columns: DataFrame) -> DataFrame:
    """One row per table with its task, null where none fits.

    A task fits when each of its required roles has a column.  Tasks are tried
    in catalog order, except that an image column puts the image task first
    and a typed message list puts the chat task next.
    """
    needed = (
        alias_table(columns.sparkSession).filter("required")
        .groupBy("task").agg(F.count_distinct("role").alias("needed"))
    )
    per_task = _hits(columns).groupBy("table_name", "task", "task_rank").agg(
        F.count_distinct(F.when(F.col("required"), F.col("role"))).alias("met"),
        F.bool_or(
            (F.col("task") == "chat") & F.col("column_type").startswith(CHAT_TYPE)
        ).alias("typed_chat"),
    )
    rank = (
        F.when(F.col("task") == "multimodal", -2)
        .when(F.col("typed_chat"), -1)
        .otherwise(F.col("task_rank"))
    )
    # The image task needs an image column, so where it fits it comes first.
    fitting = (
        per_task.join(F.broadcast(needed), "task")
        .filter(F.col("met") == F.col("needed"))
        .groupBy("table_name").agg(F.min_by("task", rank).alias("task"))
    )
    return columns.select("table_name").distinct().join(fitting, "table_name", "left")


def map_roles(columns: DataFrame, tasks: DataFrame | None = None) -> DataFrame:
    """One row per table: its task and the column taken for each role."""
    tasks = detect_tasks(columns) if tasks is None else tasks
    chosen = (
        _hits(columns).join(tasks, ["table_name", "task"])
        .groupBy("table_name", "role")
        .agg(F.min_by("column_name", "alias_rank").alias("column_name"))
        .groupBy("table_name").pivot("role", fv.ROLES).agg(F.first("column_name"))
    )
    return tasks.join(chosen, "table_name", "left").select("table_name", "task", *fv.ROLES)


def task_of(df: DataFrame) -> str:
    """The task of a single table, from its schema; an error when none fits."""
    kinds = {f.name.lower(): f.dataType.simpleString() for f in df.schema.fields}
    order = list(fv.TASK_ORDER)
    if kinds.get("messages", "").startswith(CHAT_TYPE):
        order.insert(0, "chat")
    order.insert(0, "multimodal")
    for task in order:
        wanted = [a for t, _, required, a in fv.TASK_CATALOG if t == task and required]
        if all(kinds.keys() & set(aliases) for aliases in wanted):
            return task
    raise ValueError(f"no task fits the columns {df.columns}")


def roles_of(df: DataFrame, task: str | None = None) -> dict[str, str | None]:
    """Role to column for a single table; ``task`` overrides the detection."""
    task = task_of(df) if task is None else task
    names = {c.lower(): c for c in df.columns}
    roles: dict[str, str | None] = dict.fromkeys(fv.ROLES)
    for owner, role, _, aliases in fv.TASK_CATALOG:
        if owner == task:
            roles[role] = next((names[a] for a in aliases if a in names), None)
    return roles


def role_coverage(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table, and rows whose mapped answer column is not blank."""
    def count(name: str, df: DataFrame) -> DataFrame:
        try:
            column = roles_of(df)["chosen"]
        except ValueError:
            column = None
        filled = F.lit(False) if column is None else strip(answer_text(df, column)) != ""
        return df.agg(
            F.lit(name).alias("table_name"), F.count("*").alias("n_rows"),
            F.count_if(filled).alias("n_answered"),
        )
    return reduce(DataFrame.unionByName, [count(n, d) for n, d in tables.items()])
