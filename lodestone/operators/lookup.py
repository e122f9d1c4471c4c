"""Looking up per-article values for result lists and lists of ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fetch(
    rows: DataFrame, table: DataFrame, key: str, value: str, default=None, asked: DataFrame | None = None
) -> DataFrame:
    """Left join of one value of a table with one row per key.

    The table may cover the whole corpus while few of its keys are asked for. An outer join could not broadcast
    the asking side, so the table is first reduced to those keys by a semi join, which can. ``asked`` are the
    distinct keys, if at hand in a cheaper form than ``rows``.
    """
    asked = rows.select(key).distinct() if asked is None else asked
    hits = table.select(key, value).join(asked, key, "left_semi")
    joined = rows.join(hits, key, "left")
    return joined if default is None else joined.withColumn(value, F.coalesce(F.col(value), F.lit(default)))


def lookup(requests: DataFrame, table: DataFrame, value: str, default=0) -> DataFrame:
    """``(request_id, ids)`` and ``table(id, value)`` -> ``(request_id, pos, id, value)``.

    One row per requested id, repeats and unknown ids included; ``pos`` is its place in the list and unknown
    ids get ``default``. An empty list gives no rows.
    """
    asked = requests.select("request_id", F.posexplode("ids").alias("pos", "id"))
    return fetch(asked.withColumn("pos", F.col("pos").cast("long")), table, "id", value, default)
