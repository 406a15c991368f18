"""grovespark.operators"""
