"""Column functions; plain Python cores are kept small and testable without Spark."""
