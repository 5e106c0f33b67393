"""Shared pieces for the registered queries over the driver's tables.

Table roles (SURVEY §7.4): ``lineitem`` is the telemetry table
(``l_quantity`` torque, ``l_extendedprice`` speed, ``l_discount`` / ``l_tax``
the two temperatures, ``l_returnflag`` the product type, ``l_linestatus`` the
binary label); ``events`` is the request log; ``labels`` x ``documents`` give
imbalanced labels with a score; ``embeddings`` feeds neighbour search.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from telemetra.sources.tables import table

MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
SPLIT_TS = "1999-01-01"


def lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem")


def reference_period(df: DataFrame) -> DataFrame:
    return df.where(F.col("l_shipdate") < F.lit(SPLIT_TS).cast("timestamp"))


def current_period(df: DataFrame) -> DataFrame:
    return df.where(F.col("l_shipdate") >= F.lit(SPLIT_TS).cast("timestamp"))


def line_label() -> Column:
    """Binary label of a line: open lines count as the positive class."""
    return F.when(F.col("l_linestatus") == "O", 1).otherwise(0)


def scored_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, y, score, score2): ``labels.toxic`` with the document length as
    the first score and the mean word length as a second score."""
    lab = table(spark, sf_dir, "labels")
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars", "text")
    words = F.length("text") - F.length(F.regexp_replace("text", " ", "")) + 1
    return (lab.join(docs, "doc_id")
            .select("doc_id", F.col("toxic").cast("int").alias("y"),
                    F.col("n_chars").cast("double").alias("score"),
                    (F.col("n_chars").cast("double") / words).alias("score2")))


# DuckDB fragments mirroring the helpers above
SQL_REF = "(SELECT * FROM lineitem WHERE l_shipdate < TIMESTAMP '1999-01-01')"
SQL_CUR = "(SELECT * FROM lineitem WHERE l_shipdate >= TIMESTAMP '1999-01-01')"
SQL_SCORED = """(SELECT l.doc_id, CAST(l.toxic AS INTEGER) AS y,
       CAST(d.n_chars AS DOUBLE) AS score,
       CAST(d.n_chars AS DOUBLE)
         / (length(d.text) - length(replace(d.text, ' ', '')) + 1) AS score2
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"""


def sql_unpivot(src: str, cols: list[str], name: str = "column_name", value: str = "x") -> str:
    cl = ", ".join(cols)
    return (f"(SELECT {name}, CAST({value} AS DOUBLE) AS {value} FROM "
            f"(UNPIVOT (SELECT {cl} FROM {src}) ON {cl} INTO NAME {name} VALUE {value}) "
            f"WHERE {value} IS NOT NULL AND NOT isnan(CAST({value} AS DOUBLE)))")


def sql_edges(long_cte: str, keys: str = "column_name", bins: int = 10) -> str:
    """Inner bin edges from a long CTE (keys, x)."""
    grid = ", ".join(f"{i / bins}" for i in range(bins + 1))
    return (f"(SELECT {keys}, qs[2:len(qs)-1] AS edges FROM "
            f"(SELECT {keys}, list_sort(list_distinct(quantile_cont(x, [{grid}]))) AS qs "
            f"FROM {long_cte} GROUP BY {keys}))")
