"""The warehouse's jobs and queries, one module per layer or kind of question."""
