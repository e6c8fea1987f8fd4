"""Product feature preparation, segmentation and publication as Spark DataFrame operators."""
