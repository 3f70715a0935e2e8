"""pricepanel.plans."""
