"""Reading reviews into the standard schema and writing result tables."""
