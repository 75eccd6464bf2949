"""The library's operators bound to the driver's test tables."""
