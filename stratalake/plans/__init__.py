"""Named analytics and the layered load jobs."""
