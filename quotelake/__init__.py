"""quotelake: a market-data lake and its analyses as Spark DataFrame plans."""
