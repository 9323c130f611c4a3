"""Raw transactions for the tests."""

from __future__ import annotations

from daybook.operators.clean import RAW_COLUMNS

RAW_SCHEMA = ", ".join(f"{c} string" for c in RAW_COLUMNS)


def raw_df(spark, rows):
    """Raw transactions from (ts, project_id, event, props, nums) tuples."""
    return spark.createDataFrame(rows, RAW_SCHEMA)


def tx(ts="2023-10-01 12:00:00", project="P", symbol="USD", volume="1.0", event=""):
    return (ts, project, event, f'{{"currencySymbol": "{symbol}"}}', f'{{"currencyValueDecimal": "{volume}"}}')
