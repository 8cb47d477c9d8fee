"""Plans: feature builds, jobs and the registered queries."""
