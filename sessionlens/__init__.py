"""sessionlens — shop-session analytics as lazy PySpark DataFrame operators.

Every public operator is a function ``DataFrame -> DataFrame`` (or returns a
``dict[str, DataFrame]`` for whole reports). Nothing is collected to the
driver; results stay lazy until the caller acts on them.
"""

from sessionlens.config import ensure_checkpoint_dir, local_session

__all__ = ["local_session", "ensure_checkpoint_dir"]
