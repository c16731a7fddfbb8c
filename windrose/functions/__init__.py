"""Column-level helpers (scalar functions); all are JVM-side expressions."""

from windrose.functions.scalar import *  # noqa: F401,F403
from windrose.functions.scalar import __all__  # noqa: F401
