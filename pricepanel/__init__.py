"""pricepanel: a Spark-native engine for panels of rental-price listings.

Every operator is a plain ``DataFrame -> DataFrame`` function built from
Spark's own expressions, so Catalyst sees (and optimises) the whole plan.
"""

__version__ = "0.1.0"
