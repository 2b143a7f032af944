"""Batch jobs: `python -m clicktrail.jobs <job> ...`."""
