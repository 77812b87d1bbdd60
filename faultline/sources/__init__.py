"""Sources (file readers, proxy adapters over the driver tables) and sinks."""
