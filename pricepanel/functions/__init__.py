"""pricepanel.functions."""
