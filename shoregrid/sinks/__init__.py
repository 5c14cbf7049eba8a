"""Writers and table upkeep."""
