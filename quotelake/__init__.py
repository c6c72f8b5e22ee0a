"""A lake of market quotes on Spark: raw events in, checked tables out."""

from quotelake.config import LakeConfig
from quotelake.operators import QualityError
from quotelake.session import build_session

__all__ = ["LakeConfig", "QualityError", "build_session"]
__version__ = "0.1.0"
