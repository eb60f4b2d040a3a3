"""depthbook: order-book depth analytics written as Spark DataFrame jobs."""
