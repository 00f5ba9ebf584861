"""Pure DataFrame operators shared by the batch and the incremental jobs."""
