"""voxlake: volumetric object analytics on Spark DataFrames."""
