"""meterloom: sensor-statistics processing as lazy Spark DataFrame functions."""
