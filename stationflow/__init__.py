"""Station and grid time-series analytics as plain ``DataFrame -> DataFrame`` functions."""
