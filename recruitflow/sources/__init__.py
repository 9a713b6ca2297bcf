"""Sources (35 recruiting tables) and sinks."""
