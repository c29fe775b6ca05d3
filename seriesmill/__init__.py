"""Analytics over multi-channel sensor recordings, on Spark."""
