"""The two stream jobs and their control."""
