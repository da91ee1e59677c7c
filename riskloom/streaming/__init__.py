"""Apply-side operators on Structured Streaming frames."""
