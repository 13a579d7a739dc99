"""Tables read and written, and the sample inputs derived from the test tables."""
