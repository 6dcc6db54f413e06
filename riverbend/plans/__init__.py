"""The query catalogue over the driver's tables and its SQL oracle."""
