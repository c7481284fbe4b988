"""Reading, fingerprinting, staging and publishing tables."""
