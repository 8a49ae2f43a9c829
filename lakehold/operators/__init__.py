"""DataFrame operators: quality flags and reports, Silver shaping, Gold aggregates,
quarantine, profiling, lineage and monitoring."""
