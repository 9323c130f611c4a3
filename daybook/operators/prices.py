"""The price lookup table: upper-cased symbol, last row wins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Header of a price CSV file.
PRICE_CSV_COLUMNS = ("ID", "Symbol", "Name", "Price (USD)")
LOOKUP_COLUMNS = ("symbol", "price")


def latest_prices(
    prices: DataFrame,
    symbol: str | Column = "Symbol",
    price: str | Column = "Price (USD)",
    order: str | Column = "_row_order",
) -> DataFrame:
    """One row per upper-cased symbol: ``symbol``, ``price``.

    When a symbol appears more than once (in any case), the row that comes
    last in ``order`` wins.  A missing price counts as 0.0 and is still a
    price.  ``max_by`` is a partial aggregate, so duplicates collapse map-side.
    """
    symbol_col = F.col(symbol) if isinstance(symbol, str) else symbol
    price_col = F.col(price) if isinstance(price, str) else price
    order_col = F.col(order) if isinstance(order, str) else order
    return (
        prices.select(
            F.upper(F.coalesce(symbol_col, F.lit(""))).alias("symbol"),
            F.coalesce(price_col.cast("double"), F.lit(0.0)).alias("price"),
            order_col.alias("_order"),
        )
        .groupBy("symbol")
        .agg(F.max_by("price", "_order").alias("price"))
    )


def inline_prices(spark, prices: dict[str, float]) -> DataFrame:
    """A lookup table from a small literal mapping (symbols used as given).

    Built as a SQL ``VALUES`` relation: a local table the driver broadcasts
    directly, with no job to collect it.  Its size is known on the driver:
    pass ``broadcast=len(prices) <= limit`` to the join instead of counting it.
    """
    if not prices:
        return spark.sql("SELECT CAST(NULL AS string) AS symbol, CAST(NULL AS double) AS price WHERE false")
    rows = ", ".join(
        "('{}', CAST('{}' AS double))".format(symbol.replace("'", "''"), repr(float(price)))
        for symbol, price in prices.items()
    )
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(symbol, price)")
