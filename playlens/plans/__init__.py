"""End-to-end plans: registered queries, their SQL oracles and batch jobs."""
