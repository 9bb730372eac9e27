"""contrail: flight-operations analytics as Spark DataFrame operators.

Every public operator is a function ``DataFrame -> DataFrame`` (or a small
composition of them).  Nothing is materialised on the driver: plans are
declared lazily and Catalyst/AQE choose the physical strategy.
"""

from contrail.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
