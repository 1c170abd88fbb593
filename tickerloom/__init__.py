"""tickerloom: price-bar analytics as Spark DataFrame jobs.

Every operator takes a DataFrame and returns a DataFrame, so the operators chain with
``df.transform(...)`` and the whole chain stays one lazy Catalyst plan.
"""

from tickerloom.params import Params

__all__ = ["Params"]
