"""tidewheel: time-series analytics and forecasting for many series at once, on PySpark."""

from tidewheel.session import get_spark

__all__ = ["get_spark"]
