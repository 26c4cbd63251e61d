"""Operators on volumes in voxel form (one row per voxel) and block form (one row per box of voxels)."""
