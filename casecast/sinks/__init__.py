"""Where results go: run folders, result tables, text reports and saved models."""
