"""Record flows over tables, line files and JSON topics, written for Spark."""
