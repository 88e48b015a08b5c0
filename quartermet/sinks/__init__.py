"""Writers of staged and curated tables."""
