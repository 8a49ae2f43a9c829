"""lakehold: a Spark-native medallion pipeline with data contracts, quality rules,
quarantine, personal-data masking, Gold aggregates and run monitoring."""

__version__ = "0.1.0"
