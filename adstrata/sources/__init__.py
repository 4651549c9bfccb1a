"""Tables: where they are, how they are made, read and appended to."""
