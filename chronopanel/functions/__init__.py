"""Column functions (scalar expressions). All return ``Column`` objects built
from Spark built-ins, so they stay inside whole-stage code generation."""

from .dates import *  # noqa: F401,F403
from .numbers import *  # noqa: F401,F403
from .text import *  # noqa: F401,F403
