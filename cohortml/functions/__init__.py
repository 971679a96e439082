"""Column helpers shared by the operators."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def safe_corr(x, y) -> Column:
    """Pearson correlation aggregate that is null (not an error under ANSI mode) when either
    variable has no spread: cov_pop / (sd_pop(x) sd_pop(y))."""
    x = F.col(x) if isinstance(x, str) else x
    y = F.col(y) if isinstance(y, str) else y
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def bounded(table: DataFrame, most: int = 10_000) -> DataFrame:
    """``table`` marked for broadcast if a count shows that it has at most ``most`` rows; a longer
    one comes back as it is, for an ordinary join.

    For tables with a row per class or feature, whose size the planner would guess from the rows
    that they were computed from.
    """
    rows = table.limit(most + 1).collect()
    if len(rows) > most:
        return table
    return F.broadcast(table.sparkSession.createDataFrame(rows, table.schema))
