"""Operators of a training-data pipeline.  Nothing else in voxlake imports this subpackage."""
