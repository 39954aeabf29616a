"""The jobs: extract, transform and load; train; predict; display."""
