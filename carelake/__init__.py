"""carelake: medallion analytics for clinical and claims tables on Apache Spark.

Every operator is a lazy ``DataFrame -> DataFrame`` function built from the
DataFrame/SQL API; nothing in the core collects rows to the driver.
"""

from carelake.params import Params

__all__ = ["Params"]
__version__ = "0.1.0"
