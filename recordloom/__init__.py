"""Change tracking for collections of versioned, semi-structured records, on Spark."""
