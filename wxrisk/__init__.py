"""Weather-risk analytics as Spark DataFrame operators.

Every operator takes a DataFrame and returns a DataFrame, starts no job of its
own, and can be used in batch plans and inside streaming micro-batches.
"""

__version__ = "0.1.0"
