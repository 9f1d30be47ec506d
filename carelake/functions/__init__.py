"""Column expressions (built-in Spark functions only; no UDFs)."""

from carelake.functions.expressions import *  # noqa: F401,F403
from carelake.functions.expressions import __all__  # noqa: F401
