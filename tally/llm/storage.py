"""Intermediate tables in the folder that the driver and all executors share."""

from tally.storage import shared_folder, stored

__all__ = ["shared_folder", "stored"]
