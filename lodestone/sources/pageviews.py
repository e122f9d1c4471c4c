"""Monthly page-view dumps: space-separated text, one article per line, field 1 the project, field 3 the
article id and field 5 the month's views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_page_view_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines as ``value``. bz2 files are read directly and split between tasks."""
    return spark.read.text(path)


def page_views(lines: DataFrame, project: str = "en.wikipedia") -> DataFrame:
    """``(id, views)``: views of the project's articles summed by id. Lines whose id or count is not all
    digits are skipped."""
    fields = F.split("value", " ")
    digits = r"^[0-9]+$"
    return (
        lines.where(F.col("value").startswith(project))
        .select(F.get(fields, F.lit(2)).alias("id"), F.get(fields, F.lit(4)).alias("views"))
        .where(F.col("id").rlike(digits) & F.col("views").rlike(digits))
        .select(F.col("id").try_cast("long").alias("id"), F.col("views").try_cast("long").alias("views"))
        .where(F.col("id").isNotNull())
        .groupBy("id")
        .agg(F.sum("views").alias("views"))
    )


def rejected_lines(lines: DataFrame, project: str = "en.wikipedia") -> DataFrame:
    """The project's lines that :func:`page_views` skips, with a ``reason``: too few fields, no id (of digits that fit
    64 bits), or no count."""
    fields = F.split("value", " ")

    def number(field: int):
        text = F.get(fields, F.lit(field))
        return F.when(text.rlike(r"^[0-9]+$"), text.try_cast("long"))

    reason = F.when(F.size(fields) < 5, "too few fields").when(number(2).isNull(), "no id")
    reason = reason.when(number(4).isNull(), "no count")
    rows = lines.where(F.col("value").startswith(project)).withColumn("reason", reason)
    return rows.where(F.col("reason").isNotNull())
