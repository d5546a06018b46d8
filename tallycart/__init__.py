"""tallycart: shop-event analytics as plain Spark DataFrame jobs."""
