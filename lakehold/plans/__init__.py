"""Plans: the derived chain over the test tables, the pipeline jobs, the query registry."""
