"""Set-at-a-time credit-bureau analytics on Spark."""
