"""Shared working storage, as the rest of the library has it."""

from grovespark.scratch import discard, materialize, shared_folder

__all__ = ["discard", "materialize", "shared_folder"]
