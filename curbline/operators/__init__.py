"""DataFrame-to-DataFrame operators used by batch and streaming jobs."""
