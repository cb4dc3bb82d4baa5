"""Tables in and out, and the synthetic feature generator."""
