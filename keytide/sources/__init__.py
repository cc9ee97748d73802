"""Tables, literal rows and streams to read from."""
