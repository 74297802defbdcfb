"""The end-to-end jobs: extract, transform, load."""
