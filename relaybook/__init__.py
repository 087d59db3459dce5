"""relaybook: device-message relaying and exact running counters on Spark DataFrames and streams."""
