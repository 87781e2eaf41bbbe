"""The scoring stream, its output tables and the reads over them."""
