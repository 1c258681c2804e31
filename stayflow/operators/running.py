"""Running values over the earlier rows of a key, safe for keys holding most of the data.

A window over a key puts all rows of the key into one task. Here the key's rows
are first cut into spans of the (integer) sequence: a plain aggregate reduces
each span to one row, a window over those few rows carries the value across
spans, and a second window runs only inside a span. With unique sequence
numbers no task ever sees more than ``span`` rows of a key, nor more spans
than ``range / span``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SPAN = 1 << 20


def span_of(seq: str, span: int = SPAN) -> Column:
    return F.floor(F.col(seq) / F.lit(span)).cast("bigint")


def earlier(df: DataFrame, keys: list[str], seq: str, value: Column, out: str, how: str = "max", span: int = SPAN) -> DataFrame:
    """Add ``out``: the max, the sum, or the last non-null, of ``value`` over strictly earlier rows of the key."""
    rows = df.withColumn("_value", value).withColumn("_span", span_of(seq, span))
    if how in ("max", "sum"):
        total = getattr(F, how)("_value")
    else:
        total = F.max_by("_value", F.when(F.col("_value").isNotNull(), F.col(seq)))
    before = Window.partitionBy(*keys).orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy(*keys, "_span").orderBy(seq).rowsBetween(Window.unboundedPreceding, -1)

    def over(column: str, frame) -> Column:
        return getattr(F, how)(column).over(frame) if how in ("max", "sum") else F.last(column, ignorenulls=True).over(frame)

    carried = (
        rows.groupBy(*keys, "_span")
        .agg(total.alias("_total"))
        .withColumn("_carried", over("_total", before))
        .select(*keys, "_span", "_carried")
    )
    local = rows.withColumn("_local", over("_value", inside))
    joined = local.join(carried, [*keys, "_span"], "left")
    if how == "max":
        result = F.greatest("_local", "_carried")
    elif how == "sum":
        result = F.coalesce("_local", F.lit(0)) + F.coalesce("_carried", F.lit(0))
    else:
        result = F.coalesce("_local", "_carried")
    return joined.withColumn(out, result).select(*df.columns, out)
