"""End-to-end plans: one audit run, its outputs, and the registered queries."""
