"""DataFrame-level operators."""
from ferrule.operators.history import *  # noqa: F401,F403
from ferrule.operators.stats import *  # noqa: F401,F403
from ferrule.operators.quality import *  # noqa: F401,F403
