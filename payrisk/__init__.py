"""Payment-risk analytics on Spark: features, counts, marts, models and live scoring."""

from payrisk.session import create_session, shared_dir

__all__ = ["create_session", "shared_dir"]
