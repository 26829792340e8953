"""Column functions: text rules, identity, chunking, encoding."""
