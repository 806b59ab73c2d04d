"""Customer-attrition analytics as DataFrame-to-DataFrame functions on Spark."""
