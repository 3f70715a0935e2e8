"""pricepanel.streaming."""
