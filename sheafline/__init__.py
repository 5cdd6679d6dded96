"""Document-pipeline analytics expressed as Spark DataFrame and streaming jobs."""

from sheafline.session import build_session, prepare, shared_folder

__all__ = ["build_session", "prepare", "shared_folder"]
