"""Change-data lakehouse analytics for taxi trips, written as Spark DataFrame functions."""
