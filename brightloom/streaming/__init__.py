"""The stateless operators on streaming frames."""
