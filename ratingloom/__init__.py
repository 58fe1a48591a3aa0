"""Rating analytics on Spark: batch, streaming, keyed cells and derived views."""
