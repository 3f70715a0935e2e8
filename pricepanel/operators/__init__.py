"""pricepanel.operators."""
