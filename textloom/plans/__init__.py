"""End-to-end preparation plans and the registered queries."""
