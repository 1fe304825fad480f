"""Column-level helpers: every function takes and returns Columns, so it stays inside codegen."""
from ferrule.functions.semantics import *  # noqa: F401,F403
from ferrule.functions.rowwise import *  # noqa: F401,F403
from ferrule.functions.rules import *  # noqa: F401,F403
