"""stemma: catalogue reconstruction and corpus analytics on Spark DataFrames."""
