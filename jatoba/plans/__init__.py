"""The bronze, silver and gold jobs."""
