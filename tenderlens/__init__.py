"""tenderlens: Spark-native analytics for tender notices and their bids.

Every operator is a function ``DataFrame -> DataFrame`` (or a fit function
returning a small statistics DataFrame); nothing of data size is collected to
the driver.
"""

from tenderlens.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
