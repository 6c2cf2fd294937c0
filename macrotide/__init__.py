"""Price and macro-economic analytics as Spark DataFrame operators."""

from macrotide.session import get_session, scratch_dir

__all__ = ["get_session", "scratch_dir"]
