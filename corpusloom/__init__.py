"""Fine-tuning data preparation and training-log analytics as Spark jobs."""
