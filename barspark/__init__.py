"""barspark: DataFrame operators for market-style bar data on Apache Spark."""
from .session import get_session, prepare

__all__ = ["get_session", "prepare"]
__version__ = "0.1.0"
