"""chatterlens: sentiment analytics over streams and archives of short comments, on Spark."""
