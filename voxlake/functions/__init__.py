"""Part of voxlake."""
