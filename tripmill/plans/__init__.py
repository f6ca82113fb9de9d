"""Models and loads composed from operators."""
