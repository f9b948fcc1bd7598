"""parley: customer-interaction analytics as Spark DataFrame transformations."""
