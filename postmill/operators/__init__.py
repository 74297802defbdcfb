"""Frame operators: each takes and returns ``DataFrame``."""
