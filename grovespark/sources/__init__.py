"""grovespark.sources"""
