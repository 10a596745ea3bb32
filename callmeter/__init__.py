"""callmeter: customer-usage analytics as plain Spark DataFrame jobs."""
