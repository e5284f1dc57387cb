"""Named reports, jobs and the query registry."""
