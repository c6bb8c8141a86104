"""Multi-stage plans: build, probe, publish, validate, and the registered queries."""
