"""The same operators on a stream, batch by batch."""
