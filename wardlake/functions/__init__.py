"""Column expressions. All of them are built-in functions, so they stay in the JVM."""

from wardlake.functions.clinical import *  # noqa: F401,F403
from wardlake.functions.masking import mask_pii, mrn_digest  # noqa: F401
from wardlake.functions.temporal import *  # noqa: F401,F403
