"""DataFrame-to-DataFrame steps and pipeline stages."""
