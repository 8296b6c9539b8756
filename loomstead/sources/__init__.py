"""Tables, snapshots and connectors."""
