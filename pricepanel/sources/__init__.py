"""pricepanel.sources."""
