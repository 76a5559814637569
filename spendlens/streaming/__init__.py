"""Reserved: every job in scope is a bounded batch job, so there is no stream operator here."""
