"""DataFrame-to-DataFrame operators, grouped by the job they belong to."""
