"""Reading, typing and writing of star-schema tables."""
