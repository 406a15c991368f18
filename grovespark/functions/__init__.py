"""grovespark.functions"""
