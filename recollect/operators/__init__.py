"""The operators: writes, sync, memory, consolidation, search, features and quality."""
