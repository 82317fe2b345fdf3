"""Record shaping, staging, unnesting, table writes, loads and checks."""
