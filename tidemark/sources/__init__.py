"""Record scans and the versioned tables a stream keeps between runs."""
