"""Click, sensor and event-stream analytics as plain DataFrame -> DataFrame functions."""
