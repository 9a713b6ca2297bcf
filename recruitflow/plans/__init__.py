"""The six marts and the stand-in query registry."""
