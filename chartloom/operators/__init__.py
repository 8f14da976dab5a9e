"""Operators: every one takes DataFrames or Columns and gives them back lazily."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def settle(df: DataFrame, column: str) -> DataFrame:
    """Fix the value of a costly column at this point of the plan.

    A filter on a computed column is normally pushed below the projection and computes
    the column a second time, with all the columns it is made of.  Unnesting a
    one-item array stops that, row for row and without a shuffle.
    """
    kept = [c for c in df.columns if c != column]
    return df.select(*kept, F.explode(F.array(F.col(column))).alias(column))


def unnest(df: DataFrame, array: Column | str, *keys: str, item: str = "item",
           pos: str = "pos") -> DataFrame:
    """One row per array item with its position; null and empty arrays give none.

    A plain explode lets the optimiser test the array's size below the projection that
    builds it, and so build it twice; the outer form with a filter behind does not.
    """
    rows = df.select(*keys, F.posexplode_outer(array).alias(pos, item))
    return rows.filter(F.col(pos).isNotNull())
