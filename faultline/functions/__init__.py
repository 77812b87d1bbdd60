"""Column-level expressions (all JVM-side, whole-stage-codegen friendly)."""
from faultline.functions.text import *  # noqa: F401,F403
from faultline.functions.dates import *  # noqa: F401,F403
from faultline.functions.numeric import *  # noqa: F401,F403
