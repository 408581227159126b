"""Landing to clean as shards arrive."""
