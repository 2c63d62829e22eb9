"""Tables, link lists, generated tables and seed rows."""
