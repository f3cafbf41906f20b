"""Reading and writing tables, datasets, images and shards."""
