"""Reading feeds, and reading and writing the library's tables."""
