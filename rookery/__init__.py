"""rookery: Spark jobs over social-media documents, maps and follow graphs."""
