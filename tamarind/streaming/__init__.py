"""Event stream: schema, parsing, running counters and their idempotent store."""
