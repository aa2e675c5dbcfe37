"""Readers, writers and schema guards."""

from .files import *  # noqa: F401,F403
from .schema import *  # noqa: F401,F403
