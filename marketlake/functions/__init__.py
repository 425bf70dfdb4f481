"""Column-expression helpers (all JVM-side, inside whole-stage codegen)."""

from marketlake.functions.expressions import *  # noqa: F401,F403
