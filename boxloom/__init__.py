"""Batch and streaming jobs on Spark for annotated images, camera tracks and text corpora."""
