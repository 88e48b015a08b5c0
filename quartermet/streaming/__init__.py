"""Request-log analytics (batch and stream) and incremental loads."""
