"""DataFrame-to-DataFrame operators that run the same in batch jobs."""
