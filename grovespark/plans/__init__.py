"""grovespark.plans"""
