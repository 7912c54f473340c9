"""trustline: data-quality analytics for order data on Apache Spark."""

from trustline.session import spark_session

__all__ = ["spark_session"]
