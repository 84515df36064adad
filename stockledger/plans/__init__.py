"""Plans: the scheduled jobs, the registered queries, the CLI and size-checked broadcasts."""
