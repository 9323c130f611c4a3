"""daybook: transaction cleaning, USD pricing and daily volume on Spark.

Every operator is a ``DataFrame -> DataFrame`` function (compose them with
``df.transform``); jobs in :mod:`daybook.plans` wire sources, operators and
sinks together, and :mod:`daybook.streaming` runs the same operators per
micro-batch.
"""

__version__ = "0.1.0"
