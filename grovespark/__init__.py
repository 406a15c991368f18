"""grovespark: curation and analytics of very large node forests and text corpora on Spark."""
