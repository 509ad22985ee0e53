"""cladeworks: molecular-evolution and training-data analytics as Spark jobs."""
