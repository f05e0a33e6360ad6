"""Plans: the job wired end to end, the runner and plan-level helpers."""
