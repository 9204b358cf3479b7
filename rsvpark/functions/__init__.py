"""Column-expression helpers (built-in Spark functions only)."""

from rsvpark.functions.fmt import *  # noqa: F401,F403
from rsvpark.functions.text import *  # noqa: F401,F403
