"""grovespark.streaming"""
