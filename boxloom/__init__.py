"""boxloom: DataFrame operators for image-annotation data on Spark."""

from boxloom.session import configure, ensure_checkpoint_dir, shared_path

__all__ = ["configure", "ensure_checkpoint_dir", "shared_path"]
