"""Test bindings: the traffic inputs derived from the generic test tables."""
