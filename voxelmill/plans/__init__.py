"""Options, chunk and shard layouts, pyramid levels: what is decided before any voxel is read."""
