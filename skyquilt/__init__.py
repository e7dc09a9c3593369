"""skyquilt: a Spark-native engine that cuts small images out of sky tiles and keeps the tables around them."""

from .plans.job import CutoutJob
from .session import session
from .sources.config import create_config, default_config, load_toml, save_toml, validated, validated_for_processing
from .streaming.batches import CutoutStream

__all__ = ["CutoutJob", "CutoutStream", "create_config", "default_config", "load_toml", "save_toml", "session", "validated", "validated_for_processing"]
